"""Facet filters compiled to one predicate, set completeness, coverage, audit, record merge."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import number

NUM = {"eq", "neq", "lt", "lte", "gt", "gte", "between", "in", "not_in"}
DATE = {"eq", "neq", "lt", "lte", "gt", "gte", "between", "prefix", "month_in", "month_not_in"}
EDGE = "[…\"'«»“”„ ]+"
CAT = {"eq", "neq", "in", "not_in", "prefix"}


def facet_text(value: Column) -> Column:
    """How categorical values compare: lower case, white space collapsed, no ellipsis, quotes or spaces at either end."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"\s+", " "), f"^{EDGE}|{EDGE}$", "")


def facet_value(value: str) -> str:
    """A filter's value as facet_text has a column's."""
    return re.sub(f"^{EDGE}|{EDGE}$", "", re.sub(r"\s+", " ", value.lower()))


def equal_text(a: Column, b: str) -> Column:
    """Equality that tolerates a cut-off value: from 16 characters on, one may be a prefix of the other."""
    b = facet_value(b)
    near = (F.length(a) >= 16) & F.lit(len(b) >= 16) & (F.startswith(a, F.lit(b)) | F.startswith(F.lit(b), a))
    return (a == b) | near


def constraint(field: str, op: str, value, kinds: dict[str, str]) -> Column:
    """One constraint as a predicate, null or false for a missing value whatever the operator. Kinds: cat, date (ISO text),
    num, and num_text for numbers held as text; comparisons of num columns reach the scan."""
    if field not in kinds:
        raise ValueError(f"unknown field {field}")
    kind = kinds[field]
    if op not in {"num": NUM, "num_text": NUM, "date": DATE, "cat": CAT}[kind]:
        raise ValueError(f"{op} isn't for {kind} fields")
    if op in ("in", "not_in", "month_in", "month_not_in", "between") and not isinstance(value, (list, tuple)):
        raise ValueError(f"{op} takes a list")
    if isinstance(value, (list, tuple)) and not value:
        raise ValueError(f"{op} takes a list that isn't empty")
    if op == "between" and len(value) != 2:
        raise ValueError("between takes two values")
    if kind in ("num", "num_text"):
        x = F.col(field) if kind == "num" else number(F.col(field))
        value = [float(v) for v in value] if isinstance(value, (list, tuple)) else float(value)
    elif kind == "date":
        x = F.substring(F.col(field), 1, 10)
    else:
        x = facet_text(F.col(field))
    if op in ("month_in", "month_not_in"):
        month = F.when(F.substring(x, 5, 1) == "-", F.substring(x, 6, 2).try_cast("int"))
        hit = month.isin([int(v) for v in value])
        hit = hit if op == "month_in" else ~hit
    elif op == "prefix":
        hit = F.startswith(x, F.lit(facet_value(str(value)) if kind == "cat" else str(value)))
    elif kind == "cat":
        values = value if isinstance(value, (list, tuple)) else [value]
        hit = reduce(lambda a, b: a | b, [equal_text(x, str(v)) for v in values], F.lit(False))
        hit = ~hit if op in ("neq", "not_in") else hit
    else:
        hit = {
            "eq": lambda: x == value,
            "neq": lambda: x != value,
            "lt": lambda: x < value,
            "lte": lambda: x <= value,
            "gt": lambda: x > value,
            "gte": lambda: x >= value,
            "between": lambda: x.between(value[0], value[1]),
            "in": lambda: x.isin(list(value)),
            "not_in": lambda: ~x.isin(list(value)),
        }[op]()
    return hit if kind in ("num", "num_text") else hit & (F.col(field) != "")


def compile_filter(constraints: list[dict], kinds: dict[str, str]) -> Column:
    """All constraints as one predicate, which Catalyst splits and pushes down."""
    return reduce(lambda a, b: a & b, [constraint(c["field"], c["op"], c["value"], kinds) for c in constraints], F.lit(True))


def completeness(rows: DataFrame, gold: DataFrame, condition: Column, key: str = "number") -> DataFrame:
    """(key, side): gold rows that miss the condition (violation) and rows that meet it beyond gold (excess)."""
    truth = rows.where(condition).select(key)
    violation = gold.select(key).join(truth, key, "left_anti").withColumn("side", F.lit("violation"))
    excess = truth.join(gold.select(key), key, "left_anti").withColumn("side", F.lit("excess"))
    return violation.unionByName(excess)


def coverage(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, n_distinct) of every field from one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")
    return rows.select(pairs).select("x.*").where("value IS NOT NULL AND value <> ''").groupBy("field").agg(F.count("*").alias("filled"), F.countDistinct("value").alias("n_distinct"))


def separable(rows: DataFrame, gold: DataFrame, numeric: list[str], other: list[str], key: str = "number") -> DataFrame:
    """(key, separable): whether a field tells a row that isn't gold apart from all gold rows: a number outside their range,
    or a value that none of them has. A field that some gold row leaves empty tells nothing; an empty value differs."""
    stats = [f(F.col(c)).alias(f"{p}_{c}") for c in numeric for p, f in (("lo", F.min), ("hi", F.max))]
    stats += [F.collect_set(c).alias(f"set_{c}") for c in other] + [F.sum(F.col(c).isNull().cast("int")).alias(f"gap_{c}") for c in numeric + other]
    seen = gold.agg(*stats)
    tests = [(F.col(f"gap_{c}") == 0) & (F.col(c).isNull() | (F.col(c) < F.col(f"lo_{c}")) | (F.col(c) > F.col(f"hi_{c}"))) for c in numeric]
    tests += [(F.col(f"gap_{c}") == 0) & (F.col(c).isNull() | ~F.array_contains(f"set_{c}", F.col(c))) for c in other]
    outside = rows.join(gold.select(key), key, "left_anti").crossJoin(F.broadcast(seen))  # seen is one row
    return outside.select(key, F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)).alias("separable"))


def shared_facets(groups: DataFrame, fields: list[str], group: str = "g") -> DataFrame:
    """(group, n_gold, shared): the fields on which all rows of a group agree, joined by commas."""
    same = [F.when(F.count_distinct(F.trim(F.lower(F.col(f)))) == 1, F.lit(f)) for f in fields]
    full = [F.sum(F.col(f).isNull().cast("int")) for f in fields]
    marks = [F.when(n == 0, s) for n, s in zip(full, same)]
    return groups.groupBy(group).agg(F.count("*").alias("n_gold"), F.concat_ws(",", *marks).alias("shared"))


def merge_records(parts: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """One row per key: of each field the first value that isn't empty, unless a later longer one contains it."""
    taken = [
        F.aggregate(
            F.array_sort(F.collect_list(F.when(F.coalesce(F.col(f), F.lit("")) != "", F.struct(F.col(order).alias("o"), F.col(f).alias("v"))))),
            F.lit(""),
            lambda have, x: F.when((have == "") | ((F.length(x["v"]) > F.length(have)) & F.contains(F.lower(x["v"]), F.lower(have))), x["v"]).otherwise(have),
        ).alias(f)
        for f in fields
    ]
    return parts.groupBy(key).agg(*taken, F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"))


def first_values(rows: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """(key, n, fields): per document the first value of each field that isn't empty, in order."""
    cols = [F.min_by(F.nullif(F.col(f), F.lit("")), F.when(F.coalesce(F.col(f), F.lit("")) != "", F.col(order))).alias(f) for f in fields]
    return rows.groupBy(key).agg(F.count("*").alias("n"), *cols)


def gate_funnel(decisions: DataFrame, gate: str, ok: Column) -> DataFrame:
    """(gate, seen, passed, rate) per gate."""
    return decisions.groupBy(F.col(gate).alias("gate")).agg(F.count("*").alias("seen"), F.sum(ok.cast("long")).alias("passed"), F.round(F.avg(ok.cast("double")), 4).alias("rate"))


def hardest_of_batch(rows: DataFrame, batch: str, order: list[Column]) -> DataFrame:
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(batch).orderBy(*order))).where("rn = 1").drop("rn")
