"""The common inputs of the queries, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """documents by line: file_name, idx, chunk_id, title, raw_text, and lang and source as metadata."""
    docs = table(spark, d, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id"))
    parts = docs.select("doc_id", "lang", "source", name.alias("file_name"), F.posexplode(F.split("text", "\n", -1)).alias("idx", "raw_text"))
    return parts.select(
        "doc_id",
        "file_name",
        F.col("idx").cast("long").alias("idx"),
        F.concat_ws("::", "file_name", "idx").alias("chunk_id"),
        F.concat_ws("/", "lang", "source", "file_name").alias("title"),
        "raw_text",
        "lang",
        "source",
    )


def cards(spark: SparkSession, d: str) -> DataFrame:
    """Orders as records: number, customer, region, nation, price, published, phase, procedure."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey).join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("o_orderkey").cast("string").alias("number"),
        F.col("c_name").alias("customer"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("nation"),
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"),
        F.col("o_orderstatus").alias("phase"),
        F.col("o_orderpriority").alias("procedure"),
    )


CHUNKS = """chunks AS (
  SELECT d.doc_id, d.lang, d.source, 'doc_' || d.doc_id AS file_name, CAST(u.p AS BIGINT) AS idx, 'doc_' || d.doc_id || '::' || u.p AS chunk_id,
    d.lang || '/' || d.source || '/doc_' || d.doc_id AS title, string_split(d.text, chr(10))[u.p + 1] AS raw_text
  FROM documents d, LATERAL (SELECT unnest(range(len(string_split(d.text, chr(10))))) AS p) u)"""

CARDS = """cards AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS number, c_name AS customer, r_name AS region, n_name AS nation, o_totalprice AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS published, o_orderstatus AS phase, o_orderpriority AS procedure
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
NORMAL = r"regexp_replace(trim(lower({})), '\s+', ' ', 'g')"
