"""Checks of candidate questions: verbatim spans, leaks, perturbations, isolation, budgets, round-robin picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def verbatim(span: Column, text: Column) -> Column:
    """Whether a span that isn't empty occurs in a text, case and white space aside."""
    return (T.normal(span) != "") & F.contains(T.normal(text), T.normal(span))


def leaks(answer: Column, text: Column, least: float = 0.9) -> Column:
    """Whether the text holds the answer, or at least that share of the answer's distinct words of 4 letters or more."""
    whole = F.contains(T.normal(text), T.normal(answer))
    words = F.array_distinct(F.filter(T.tokens(answer), lambda w: F.length(w) >= 4))
    low = F.lower(text)
    share = T.let(words, lambda ws: F.when(F.size(ws) == 0, 0.0).otherwise(F.size(F.filter(ws, lambda w: F.contains(low, w))) / F.size(ws)))
    return whole | (share >= least)


def perturb(text: Column) -> Column:
    """The first year three later, else the first number seven higher, else the text itself."""
    year = F.regexp_extract(text, "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    number = F.regexp_extract(text, "([0-9]{1,9})", 1)
    found = F.when(year != "", year).otherwise(number)
    at = F.call_function("instr", text, found)
    new = (found.try_cast("bigint") + F.when(year != "", 3).otherwise(7)).cast("string")
    return F.when(found == "", text).otherwise(F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(found), F.lit(1 << 30))))


def lower_case_words(chunks: DataFrame) -> DataFrame:
    """(word, n): words that begin in lower case somewhere, with their occurrences as such."""
    words = chunks.select(F.explode(F.regexp_extract_all(F.col("raw_text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.where(F.col("word").rlike(r"^\p{Ll}")).groupBy("word").agg(F.count("*").alias("n"))


def pseudo_gold(density: DataFrame, sets: int, members: int = 3, seed: str = "g") -> DataFrame:
    """(set, density): drawn sets of ids with the lowest density among their members. An id goes into the sets that its
    draws name, so no list of ids is ever gathered."""
    draws = F.transform(F.sequence(F.lit(0), F.lit(members - 1)), lambda k: F.floor(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"), F.lit(":"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * sets))
    return density.select(F.explode(draws).alias("set"), "density").groupBy("set").agg(F.min("density").alias("density"))


def injection_budget(tasks: DataFrame, most: int = 15, low: float = 0.34) -> DataFrame:
    """(id, density, budget, sparse): how many chunks lift a task to the median density, and whether it lies far below."""
    median = tasks.agg(F.percentile("density", F.lit(0.5)).alias("median"))
    b = F.least(F.greatest(F.lit(0.0), F.rint(F.col("median") - F.col("density"))), F.lit(float(most)))
    return tasks.crossJoin(F.broadcast(median)).select("id", "density", b.cast("long").alias("budget"), (F.col("density") < low * F.col("median")).alias("sparse"))  # median is one row


def isolation(top: DataFrame, gold: DataFrame) -> DataFrame:
    """(query_id, own, foreign): how many of a task's retrieved chunks are its own gold, and how many another task's."""
    own = gold.select("query_id", "chunk_id", F.lit(1).alias("own"))
    owners = gold.groupBy("chunk_id").agg(F.min("query_id").alias("owner"))
    j = top.join(own, ["query_id", "chunk_id"], "left").join(owners, "chunk_id", "left")
    foreign = F.col("own").isNull() & F.col("owner").isNotNull()
    return j.groupBy("query_id").agg(F.count("own").alias("own"), F.sum(foreign.cast("long")).alias("foreign"))


def round_robin(facts: DataFrame, group: str, chunk: str, fact: str, most: int) -> DataFrame:
    """Facts of a group, one of each chunk in turn, up to most."""
    turn = facts.withColumn("turn", F.row_number().over(Window.partitionBy(group, chunk).orderBy(fact)))
    at = Window.partitionBy(group).orderBy("turn", chunk)
    return turn.withColumn("place", F.row_number().over(at)).where(F.col("place") <= most).drop("turn")
