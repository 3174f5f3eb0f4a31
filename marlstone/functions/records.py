"""Column functions over record fields and metadata. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

PLACEHOLDER = ""


def field_value(name: str, builtin: dict[str, Column], meta: Column) -> Column:
    """A built-in field, else the metadata entry of that name; empty if there is none."""
    return F.coalesce(builtin[name] if name in builtin else meta[name], F.lit(PLACEHOLDER))


def scope(strategy: str, value: Column, gap: int = 1, min_depth: int = 2) -> Column:
    """The scope of a value: its path without the leaf (path) or the value itself (exact)."""
    if strategy == "path":
        return T.path_scope(value, gap, min_depth)
    if strategy == "exact":
        return F.trim(value)
    raise ValueError(f"unknown scope strategy {strategy}")


def breadcrumb(path: Column, limit: int) -> Column:
    """The segments joined by ' > '; what is longer than limit loses its beginning to an ellipsis."""
    line = F.array_join(T.path_segments(path), " > ")
    return T.let(line, lambda x: F.when(F.length(x) <= limit, x).otherwise(F.concat(F.lit("…"), F.ltrim(F.substring(x, F.length(x) - limit + 2, F.lit(1 << 30))))))


def first_filled(*values: Column) -> Column:
    """The first value that has more than white space, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values])


def shortened(value: Column, limit: int) -> Column:
    """value, or its first limit characters without trailing spaces and an ellipsis."""
    return F.when(F.length(value) <= limit, value).otherwise(F.concat(F.rtrim(F.substring(value, 1, limit)), F.lit("…")))


def number(value: Column) -> Column:
    """'1 234,5' as 1234.5; null for what isn't a number."""
    bare = F.replace(F.regexp_replace(value, r"[\s\x{a0}]+", ""), F.lit(","), F.lit("."))
    return F.when(bare.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), bare.try_cast("double"))


def gloss(value: Column) -> Column:
    """'about 1.2 million' from a million on, '3.45 billion' from a thousand of them on; empty below."""
    v = F.abs(value)
    plain = lambda x, n: F.replace(F.format_number(x, n), F.lit(","), F.lit(""))
    return F.when(v >= 1e9, F.concat(plain(v / 1e9, 2), F.lit(" billion"))).when(v >= 1e6, F.concat(F.lit("about "), plain(v / 1e6, 1), F.lit(" million"))).otherwise("")


def percent(value: Column) -> Column:
    """'30.00%' as '30 %'; anything else as it is."""
    whole = F.regexp_extract(value, r"^\s*(-?[0-9]+)(?:[.,]([0-9]*?)0*)?\s*%\s*$", 1)
    part = F.regexp_extract(value, r"^\s*(-?[0-9]+)(?:[.,]([0-9]*?)0*)?\s*%\s*$", 2)
    return F.when(whole == "", value).otherwise(F.concat(whole, F.when(part == "", "").otherwise(F.concat(F.lit(","), part)), F.lit(" %")))


def values(packed: Column, most: int = 40) -> Column:
    """The parts of a packed list, split at '||' or at ';' with two spaces or more, trimmed, without empty ones; the first
    `most` of them, since a list field holds no more."""
    parts = F.filter(F.transform(F.split(packed, r"\|\||;\s{2,}", -1), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(parts, 1, most)


def looked_up(code: Column, names: dict[str, str]) -> Column:
    """The name of a code, leading zeros aside; the code itself if it has none."""
    bare = F.regexp_replace(F.trim(code), "^0+(?=.)", "")
    table = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    return F.coalesce(table[bare], F.trim(code))


def like_stem(word: Column, stems: list[str], size: int = 6) -> Column:
    """Whether a word equals a listed one, or shares its first `size` letters with one that has as many."""
    low = F.lower(word)
    long = [s.lower() for s in stems if len(s) >= size]
    return low.isin([s.lower() for s in stems]) | ((F.length(low) >= size) & F.substring(low, 1, size).isin([s[:size] for s in long]))


def smart_case(name: Column, keep: tuple[str, ...] = (), small: tuple[str, ...] = ("of", "the", "and", "for", "in"), acronym: int = 4) -> Column:
    """A name in capitals as it is written: listed abbreviations, Roman numerals and short words without a vowel stay,
    connectives go small, other words keep their first capital. A name with small letters stays whole."""

    def word(w, i):
        bare = F.regexp_replace(w, r"[^\p{L}\p{N}]", "")
        held = bare.isin(*keep) if keep else F.lit(False)
        held = held | bare.rlike("^[IVXLC]+$") | ((F.length(bare) <= acronym) & ~bare.rlike("[AEIOUY]"))
        at = F.regexp_extract(w, r"^([^\p{L}]*)", 1)
        rest = F.substring(w, F.length(at) + 1, F.lit(1 << 30))
        title = F.concat(at, F.upper(F.substring(rest, 1, 1)), F.lower(F.substring(rest, 2, 1 << 30)))
        return F.when(held, w).when((i > 0) & F.lower(bare).isin(*small), F.lower(w)).otherwise(title)

    return F.when(name.rlike(r"\p{Ll}"), name).otherwise(F.array_join(F.transform(F.split(name, " ", -1), word), " "))


def observable(attribute: Column, question: Column) -> Column:
    """Whether a question shows an attribute: it holds a word of its value (what follows a colon, in any part between
    arrows, commas and semicolons) of 2 characters or more, and of more than 3 if it is letters only."""
    parts = F.split(attribute, "->|[,;]", -1)
    said = F.transform(parts, lambda p: F.regexp_replace(p, "^[^:]*:", ""))
    words = F.flatten(F.transform(said, lambda p: T.tokens(p)))
    asked = F.lower(question)
    return F.exists(words, lambda w: (F.length(w) >= 2) & F.contains(asked, w) & (~w.rlike(r"^\p{L}+$") | (F.length(w) > 3)))


def problems(flags: dict[str, Column]) -> Column:
    """The names of the flags that hold, in order, joined by commas; empty means passed."""
    return F.concat_ws(",", *[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in flags.items()])


def members(wanted: Column, valid: Column) -> Column:
    """The distinct wanted ids that are valid, in order of first mention."""
    return F.filter(F.array_distinct(wanted), lambda x: F.array_contains(valid, x))


def sentence(*parts: Column) -> Column:
    """Parts that aren't null joined by spaces, ended by a stop."""
    line = F.concat_ws(" ", *parts)
    return F.when(line == "", "").when(line.rlike("[.!?…]$"), line).otherwise(F.concat(line, F.lit(".")))


def record_prose(title: Column, place: dict[str, Column], money: Column, dates: dict[str, Column]) -> Column:
    """A record in paragraphs: what it is, where, for how much, when; what is missing is left out."""
    said = lambda fields: [F.concat(F.lit(f"{label} "), F.nullif(F.trim(c), F.lit(""))) for label, c in fields.items()]
    price = F.concat(F.lit("The price is "), T.money(money), F.when(gloss(money) != "", F.concat(F.lit(" ("), gloss(money), F.lit(")"))).otherwise(""))
    where = F.concat_ws(", ", *said(place))
    when = F.concat_ws(", ", *said(dates))
    paragraphs = [sentence(title), sentence(F.nullif(where, F.lit(""))), sentence(price), sentence(F.nullif(when, F.lit("")))]
    return F.concat_ws("\n", *[F.nullif(p, F.lit("")) for p in paragraphs])


def iso_date(value: Column) -> Column:
    """'2024-03-05T10:00' and '05.03.2024' as '2024-03-05'; null for other forms and days that aren't in the calendar."""
    iso = F.regexp_extract(value, r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    d = r"^\s*([0-9]{2})\.([0-9]{2})\.([0-9]{4})"
    dotted = F.concat_ws("-", F.regexp_extract(value, d, 3), F.regexp_extract(value, d, 2), F.regexp_extract(value, d, 1))
    return F.when(iso != "", iso).when(dotted != "--", dotted).otherwise(None).try_cast("date").cast("string")


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conditions])
