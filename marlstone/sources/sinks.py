"""Sinks and stage control: append with resume, decisions, cumulative counters, versions, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUBLIC = ["file_name", "index", "raw_text", "document_id", "title"]


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier run has decided, passes and rejects alike."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def add_counters(before: DataFrame, new: DataFrame) -> DataFrame:
    """(gate, seen, passed, rate) of two runs together."""
    both = before.select("gate", "seen", "passed").unionByName(new.select("gate", "seen", "passed"))
    by = both.groupBy("gate").agg(F.sum("seen").alias("seen"), F.sum("passed").alias("passed"))
    return by.withColumn("rate", F.round(F.col("passed") / F.greatest(F.lit(1), "seen"), 4))


def public_view(chunks: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """The public fields only; with a ledger, only the chunks that it injected."""
    kept = chunks if ledger is None else chunks.join(ledger.select("chunk_id"), "chunk_id", "left_semi")
    return kept.select(*PUBLIC)


def inject(chunks: DataFrame, new: DataFrame) -> DataFrame:
    """new (file_name, raw_text, ord) as chunks after the last index of their files, without texts the corpus has."""
    from pyspark.sql import Window

    from ..functions import text as T

    last = chunks.groupBy("file_name").agg(F.max("index").alias("last"))
    old = chunks.select(T.content_hash(F.col("raw_text")).alias("h")).distinct()
    fresh = new.withColumn("h", T.content_hash(F.col("raw_text"))).join(old, "h", "left_anti")
    fresh = fresh.withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy("file_name", "ord"))).where("k = 1")
    at = F.row_number().over(Window.partitionBy("file_name").orderBy("ord"))
    placed = fresh.join(last, "file_name", "left").withColumn("index", F.coalesce("last", F.lit(-1)) + at)
    return placed.select(F.concat_ws("::", "file_name", "index").alias("chunk_id"), "file_name", "index", "raw_text")
