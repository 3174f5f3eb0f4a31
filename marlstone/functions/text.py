"""Text functions, Column -> Column. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
SUFFIXES = ("ings", "tion", "ing", "ung", "eau", "ado", "ed", "es", "er", "en", "on", "s", "e")


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda computes a captured expression anew for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def stem(token: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The token without its longest listed suffix, if it has more than 4 characters, 4 of them left, and is no number."""
    ends = "|".join(sorted(suffixes, key=lambda s: (-len(s), s)))
    cut = F.regexp_replace(token, f"^(.{{4,}}?)({ends})$", "$1")
    return F.when((F.length(token) <= 4) | token.rlike("^[0-9]+$"), token).otherwise(cut)


def stemmed(word: str, suffixes: tuple[str, ...] = tuple(sorted(SUFFIXES, key=lambda s: (-len(s), s)))) -> str:
    """stem for one word, where words are at hand one by one."""
    if len(word) > 4 and not (word.isascii() and word.isdigit()):
        for s in suffixes:
            if len(word) - len(s) >= 4 and word.endswith(s):
                return word[: -len(s)]
    return word


def normal(text: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.regexp_replace(F.trim(F.lower(text)), r"\s+", " ")


def content_hash(text: Column) -> Column:
    return F.sha1(normal(text))


def template_hash(text: Column) -> Column:
    """The content hash with every run of digits masked."""
    return F.sha1(F.regexp_replace(normal(text), r"[0-9]+", "#"))


def n_words(text: Column) -> Column:
    """Runs between white space; 0 for an empty text."""
    bare = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " ")))


def letter_ratio(text: Column) -> Column:
    """Letters among the characters that are no white space; 0 if there are none."""
    seen = F.length(F.regexp_replace(text, r"\s+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.when(seen == 0, 0.0).otherwise(letters / seen)


def script_ratio(text: Column, script: str = r"\p{IsLatin}") -> Column:
    """Letters of a script among all letters; 0 if there are none."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    own = F.length(F.regexp_replace(text, f"[^{script}]+", ""))
    return F.when(letters == 0, 0.0).otherwise(own / letters)


def shingles(words: Column, k: int) -> Column:
    """Distinct k-grams of an array of words; all words as one if there are fewer. words is evaluated once."""
    return let(
        words,
        lambda w: F.when(F.size(w) < k, F.array(F.array_join(w, " "))).otherwise(
            F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.array_join(F.slice(w, i, k), " ")))
        ),
    )


def minhash(grams: Column, n: int = 64) -> Column:
    """The n least values of md5(permutation:shingle) cut to 32 bits, zeros for no shingles."""
    value = lambda p: lambda s: F.conv(F.substring(F.md5(F.concat_ws(":", p.cast("string"), s)), 1, 8), 16, 10).cast("long")
    return let(grams, lambda g: F.when(F.size(g) == 0, F.array_repeat(F.lit(0).cast("long"), n)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda p: F.array_min(F.transform(g, value(p))))))


def unit(key: Column, seed: str) -> Column:
    """A uniform in [0, 1) drawn from seed and key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def clean(text: Column) -> Column:
    """Control characters and white space collapsed, placeholders emptied, quotes and dashes made typographic."""
    t = F.trim(F.regexp_replace(F.regexp_replace(text, r"[\x00-\x1f]+", " "), r"\s+", " "))
    t = F.regexp_replace(F.regexp_replace(t, '"([^"]*)"', "«$1»"), " - ", " — ")
    t = F.regexp_replace(t, r" +([,.;:!?])", "$1")
    return F.when(F.lower(t).isin("", "-", "—", "nan", "none", "null", "n/a", "0"), "").otherwise(t)


def path_segments(path: Column) -> Column:
    return F.filter(F.transform(F.split(path, "/"), lambda s: F.trim(s)), lambda s: s != "")


def path_scope(path: Column, gap: int = 1, min_depth: int = 2) -> Column:
    """The path without its leaf and gap further levels; empty if fewer than min_depth segments remain."""
    cut = lambda s: F.size(s) - 1 - gap
    return let(path_segments(path), lambda s: F.when(cut(s) < max(1, min_depth), "").otherwise(F.array_join(F.slice(s, 1, F.greatest(cut(s), F.lit(0))), "/")))


def money(value: Column) -> Column:
    """1234567.5 -> '1 234 567,50'."""
    return F.translate(F.format_number(value, 2), ",.", " ,")


def price_bucket(value: Column) -> Column:
    v = F.abs(value)
    out = F.when(v < 1e4, "under 10k")
    for edge, name in ((1e5, "10k-100k"), (2e5, "100k-200k"), (4e5, "200k-400k")):
        out = out.when(v < edge, name)
    return out.otherwise("over 400k")
