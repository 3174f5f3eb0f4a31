"""Operators whose meaning is sequential within a small group: folds in the JVM, grouped pandas where a fold won't do."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = ("low", "mid", "high")


def datamix_select(rows: DataFrame, target: tuple[float, float, float] = (0.3, 0.4, 0.3)) -> DataFrame:
    """(batch, id, bin): per batch, in order, the candidate whose bin is furthest below its target share of the picks so far;
    ties by larger gap, then id. Within a bin the best candidate of a batch doesn't depend on the picks, so at most three are
    left of each batch; one task streams through those in order and holds three counters."""
    place = F.when(F.col("bin") == "low", 0).when(F.col("bin") == "mid", 1).otherwise(2)
    best = [F.max(F.when(place == i, F.struct("gap", "id", "bin"))).alias(f"c{i}") for i in range(3)]
    few = rows.select("batch", F.col("gap").cast("double").alias("gap"), F.col("id").cast("long").alias("id"), "bin").groupBy("batch").agg(*best)
    flat = few.select(F.col("batch").cast("long").alias("batch"), *[F.col(f"c{i}").isNotNull().alias(f"has{i}") for i in range(3)], *[F.col(f"c{i}.{f}").alias(f"{f}{i}") for i in range(3) for f in ("gap", "id", "bin")])
    cent = Decimal("0.000001")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [0, 0, 0]
        for batch in batches:
            x = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            ids, bins = [], []
            for r in range(batch.num_rows):
                here = [i for i in range(3) if x[f"has{i}"][r]]
                if len(here) > 1:
                    total = sum(n)
                    below = {i: Decimal(repr(target[i] - (n[i] / total if total else 0.0))).quantize(cent, ROUND_HALF_UP) for i in here}
                    here.sort(key=lambda i: (below[i], *[(v is not None, v or 0) for v in (x[f"gap{i}"][r], x[f"id{i}"][r])]))  # noqa: B023
                i = here[-1]
                n[i] += 1
                ids.append(x[f"id{i}"][r])
                bins.append(x[f"bin{i}"][r])
            yield pa.RecordBatch.from_arrays([batch.column("batch"), pa.array(ids, pa.int64()), pa.array(bins, pa.string())], names=["batch", "id", "bin"])

    return flat.repartition(1).sortWithinPartitions("batch").mapInArrow(run, "batch long, id long, bin string")


def disjoint_pairs(pairs: DataFrame, group: str, order: list[str], limit: int) -> DataFrame:
    """Per group, pairs (a, b) in order that share no member with one taken before, then the others, up to limit. A fold
    over each group's sorted pairs; groups are small, since bridging entities are rare by definition."""
    kind = dict(pairs.dtypes)["a"]
    pair = F.struct(*order, *[c for c in ("a", "b") if c not in order])
    start = F.struct(F.array().cast(f"array<{kind}>").alias("used"), F.array().cast(f"array<struct<a:{kind},b:{kind}>>").alias("first"), F.array().cast(f"array<struct<a:{kind},b:{kind}>>").alias("rest"))

    def step(s, x):
        one = F.array(F.struct(x["a"].alias("a"), x["b"].alias("b")))
        taken = F.array_contains(s["used"], x["a"]) | F.array_contains(s["used"], x["b"])
        return F.struct(
            F.when(taken, s["used"]).otherwise(F.concat(s["used"], F.array(x["a"], x["b"]))).alias("used"),
            F.when(taken, s["first"]).otherwise(F.concat(s["first"], one)).alias("first"),
            F.when(taken, F.concat(s["rest"], one)).otherwise(s["rest"]).alias("rest"),
        )

    folded = F.aggregate(F.array_sort(F.collect_list(pair)), start, step, lambda s: F.slice(F.concat(s["first"], s["rest"]), 1, limit))
    by = pairs.groupBy(group).agg(folded.alias("xs"))
    return by.select(group, F.posexplode("xs").alias("i", "x")).select(group, "x.a", "x.b", (F.col("i") + 1).cast("long").alias("place"))


def leave_one_out(facts: list, solvable: Callable[[list], bool], floor: int = 2) -> list:
    """Facts without those that a solver can do without, one at a time and from the start again, down to floor."""
    facts = list(facts)
    again = True
    while again and len(facts) > floor:
        again = False
        for i in range(len(facts)):
            rest = facts[:i] + facts[i + 1 :]
            if solvable(rest):
                facts, again = rest, True
                break
    return facts


def minimise(tasks: DataFrame, share: float, floor: int = 2) -> DataFrame:
    """(task, facts): leave_one_out for each task (task, xs array<struct<fact, w>>), where facts are solvable that hold at least
    that share of the task's weight. A task has a handful of facts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for task, xs in zip(batch["task"], batch["xs"]):
                facts = [(x["fact"], x["w"]) for x in xs]
                need = share * sum(w for _, w in facts)
                out.append((task, ",".join(str(f) for f, _ in leave_one_out(facts, lambda rest: sum(w for _, w in rest) >= need, floor))))  # noqa: B023
            yield pd.DataFrame(out, columns=["task", "facts"])

    return tasks.select("task", "xs").mapInPandas(run, "task long, facts string")


def echo_free(phrases: Column) -> Column:
    """Phrases without those that an earlier kept one equals or contains, ignoring case."""
    return F.aggregate(phrases, F.array().cast("array<string>"), lambda kept, p: F.when((p == "") | F.exists(kept, lambda k: F.contains(F.lower(k), F.lower(p))), kept).otherwise(F.concat(kept, F.array(p))))


def first_json(text: str | None) -> str | None:
    """The first JSON object in a text: the whole, a fenced block, or the first balanced pair of braces that parses."""
    if not text:
        return None
    decoder = json.JSONDecoder()
    at = text.find("{")
    while at >= 0:
        try:
            value, _ = decoder.raw_decode(text, at)
            return json.dumps(value, ensure_ascii=False)
        except ValueError:
            at = text.find("{", at + 1)
    return None


def extract_json(text: Column) -> Column:
    """first_json over Arrow batches."""
    return F.pandas_udf(_first_json_of_each, "string")(text)


def _first_json_of_each(texts: pd.Series) -> pd.Series:
    return texts.map(first_json)


def cut_section(title: str, lines: list[str], limit: int, more: str = "{} (part {})") -> list[str]:
    """A section as texts of at most about limit characters, cut between lines, the title repeated with its part."""
    if len("\n".join([title, *lines])) <= limit:
        return ["\n".join([title, *lines])]
    parts, held, size = [], [], len(title)
    for line in lines:
        if held and size + len(line) + 1 > limit:
            parts.append(held)
            held, size = [], len(title) + 20
        held.append(line)
        size += len(line) + 1
    if held:
        parts.append(held)
    return ["\n".join([title if i == 1 else more.format(title, i), *part]) for i, part in enumerate(parts, 1)]


def pack_sections(sections: list[tuple[str, list[str]]], max_chars: int = 1400, merge_below: int = 600, min_chars: int = 120, max_chunks: int = 40, min_chunks: int = 2) -> list[str]:
    """The chunk texts of a document: short sections take in the next one, long ones are cut, tiny ones go, and a short last
    chunk joins the one before. If that leaves fewer than min_chunks, sections aren't merged."""
    size = lambda s: len("\n".join([s[0], *s[1]]))

    def pack(below: int) -> list[str]:
        merged: list[tuple[str, list[str]]] = []
        for s in sections:
            if merged and size(merged[-1]) < below and size(merged[-1]) + size(s) <= max_chars:
                merged[-1] = (merged[-1][0], [*merged[-1][1], "", s[0], *s[1]])
            else:
                merged.append((s[0], list(s[1])))
        out = [t for s in merged for t in cut_section(*s, max_chars) if len(t) >= min_chars]
        if len(out) > 2 and len(out[-1]) < below and len(out[-2]) + len(out[-1]) + 2 <= max_chars:
            out[-2:] = ["\n\n".join(out[-2:])]
        return out[:max_chunks]

    out = pack(merge_below)
    if len(out) < min_chunks and merge_below > 0 and len(other := pack(0)) > len(out):
        return other
    return out


def chunk_records(records: DataFrame, key: str, **options) -> DataFrame:
    """(key, index, raw_text) of records with sections array<struct<title, lines>>; each record is packed on its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, sections in zip(batch[key], batch["sections"]):
                texts = pack_sections([(s["title"], list(s["lines"])) for s in (sections if sections is not None else [])], **options)
                rows += [(k, i, t) for i, t in enumerate(texts)]
            yield pd.DataFrame(rows, columns=[key, "index", "raw_text"])

    return records.select(key, "sections").mapInPandas(run, f"{key} {dict(records.dtypes)[key]}, index long, raw_text string")


def split_gold(tasks: DataFrame) -> DataFrame:
    """tasks (id, split, gold array) without training tasks that share a gold chunk with a held-out one."""
    held = tasks.where("split = 'holdout'").select(F.explode("gold").alias("g")).distinct()
    leaking = tasks.where("split = 'train'").select("id", F.explode("gold").alias("g")).join(held, "g").select("id").distinct()
    return tasks.join(leaking, "id", "left_anti")


def repair_filter(rows: DataFrame, gold: DataFrame, condition: Column, candidates: list[Column], key: str = "number", augment: int = 5, rounds: int = 2) -> tuple[str, list[int]]:
    """(exit, candidates added): adds constraints until the condition selects gold exactly.

    Exits: gold_violation (gold misses the condition), exact, repaired, augmented (a few rows in excess are taken in),
    no_progress, limit. Every round is one aggregation over the rows.
    """
    marked = rows.join(gold.select(key, F.lit(True).alias("is_gold")), key, "left").withColumn("is_gold", F.coalesce("is_gold", F.lit(False)))
    condition, candidates = F.coalesce(condition, F.lit(False)), [F.coalesce(c, F.lit(False)) for c in candidates]
    excess = lambda c: F.sum((c & ~F.col("is_gold")).cast("long"))
    lost = lambda c: F.sum((~c & F.col("is_gold")).cast("long"))
    added: list[int] = []
    now, missing = marked.agg(excess(condition), lost(condition)).first()
    if missing:
        return "gold_violation", added
    while now:
        left = [i for i in range(len(candidates)) if i not in added]
        if len(added) >= rounds or not left:
            return ("augmented" if now <= augment else "limit"), added
        counts = marked.agg(*[f(condition & candidates[i]) for i in left for f in (excess, lost)]).first()
        best = min(((counts[2 * k], i) for k, i in enumerate(left) if not counts[2 * k + 1]), default=(now, -1))
        if best[0] >= now:
            return ("augmented" if now <= augment else "no_progress"), added
        now, condition = best[0], condition & candidates[best[1]]
        added.append(best[1])
    return ("repaired" if added else "exact"), added


def ranked_quota(rows: DataFrame, group: str, order: list[Column], quota: int) -> DataFrame:
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rn") <= quota).drop("rn")
