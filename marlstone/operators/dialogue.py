"""Dialogues, judged positives, corpus versions, and the offline judge as column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .store import shared_dir


def with_checkpoints(spark: SparkSession, build):
    """build() with a checkpoint folder: the one that spark.checkpoint.dir names, or a local one where it is unset and the master is local."""
    shared_dir(spark)
    return build()


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, transcript, turns): tagged lines in order of turn."""
    line = F.concat(F.lit("<"), F.col("role"), F.lit(">"), F.col("text"), F.lit("</"), F.col("role"), F.lit(">"))
    by = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("xs"), F.count("*").alias("turns"))
    return by.select("conv_id", F.array_join(F.transform("xs", lambda x: x["line"]), "\n").alias("transcript"), "turns")


def referent(question: Column) -> Column:
    """What stands for the answer of an earlier question, by its question word."""
    q = F.lower(question)
    return F.when(F.startswith(q, F.lit("who")), "that person").when(F.startswith(q, F.lit("when")), "that date").when(F.startswith(q, F.lit("where")), "that place").otherwise("it")


def rewrite(question: Column, earlier: Column) -> Column:
    """#k in a question replaced by what the k-th earlier question asks for; the highest k first, so #1 spares #10."""
    steps = F.transform(earlier, lambda q, i: F.struct(i.alias("i"), q.alias("q")))
    return F.aggregate(F.reverse(steps), question, lambda text, x: F.replace(text, F.concat(F.lit("#"), (x["i"] + 1).cast("string")), referent(x["q"])))


def entailed(passage: Column, claim: Column, least: float = 0.75) -> Column:
    """The offline judge: at least that share of the claim's distinct words occurs in the passage."""
    words = F.array_distinct(T.tokens(claim))
    return F.size(F.array_intersect(T.tokens(passage), words)) / F.size(words) >= least


def positives(ranked: DataFrame) -> DataFrame:
    """(query_id, positives, n) from rows (query_id, text, chunk_id, raw_text, rank): passages that the judge takes, in order."""
    judged = ranked.withColumn("ok", entailed(F.col("raw_text"), F.col("text")))
    kept = F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("rank", "chunk_id"))))
    by = judged.groupBy("query_id").agg(kept.alias("xs"))
    return by.select("query_id", F.array_join(F.transform("xs", lambda x: x["chunk_id"]), ",").alias("positives"), F.size("xs").cast("long").alias("n"))


def first_version(rows: DataFrame) -> DataFrame:
    """(id, version, hash) rows without those whose content an earlier version or lower id has."""
    order = Window.partitionBy("hash").orderBy("version", "id")
    return rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
