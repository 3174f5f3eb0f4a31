"""Hybrid probes of the corpus, gaps of targets, and the gates on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import retrieval as R
from .store import written


class Probe:
    """A corpus (chunk_id, passage) indexed once for both branches."""

    def __init__(self, passages: DataFrame, text: str = "passage"):
        self.passages, self.text = passages, text
        self.index = R.lexical_index(passages, text)
        self.vectors = written(R.bow_embedding(passages.select(F.col("chunk_id").alias("id"), F.col(text).alias("text"))), "vectors")

    def branches(self, queries: DataFrame, depth: int = 100) -> tuple[DataFrame, DataFrame]:
        """(query_id, id, score, rank) of each branch for queries (query_id, text)."""
        lexical = R.bm25(self.passages, queries, depth, text=self.text, index=self.index).withColumnRenamed("chunk_id", "id")
        asked = R.bow_embedding(queries.select(F.col("query_id").alias("id"), "text"))
        return lexical, R.dense_topk(written(asked, "asked"), self.vectors, depth, skip_self=False, positive=True)

    def vectors_of(self, ids: DataFrame) -> DataFrame:
        """(chunk_id, vec) of the chunks in ids (chunk_id) only: their texts move, not all vectors."""
        texts = self.passages.join(R.small(ids.select("chunk_id").distinct()), "chunk_id", "left_semi")
        return R.bow_embedding(texts.select(F.col("chunk_id").alias("id"), F.col(self.text).alias("text"))).withColumnRenamed("id", "chunk_id")

    def hits(self, queries: DataFrame, k: int = 10, depth: int = 100) -> DataFrame:
        """(query_id, id, rrf, rank): the k best of both branches together."""
        return R.fuse(list(self.branches(queries, depth)), top=k)

    def gaps(self, queries: DataFrame, gold: DataFrame, depth: int = 100) -> DataFrame:
        """(query_id, chunk_id, lex_gap, dense_gap, fused_gap) of gold (query_id, chunk_id)."""
        lexical, dense = self.branches(queries, depth)
        fused = R.fuse([lexical, dense], top=1 << 30)
        lex = R.bm25_pairs(self.index, self.passages, queries, gold, text=self.text).withColumnRenamed("score", "lex")
        asked = R.bow_embedding(queries.select(F.col("query_id").alias("id"), "text")).select(F.col("id").alias("query_id"), F.col("vec").alias("qv"))
        own = lex.join(self.vectors_of(gold), "chunk_id", "left").join(asked, "query_id", "left")
        dot = F.aggregate(F.zip_with("vec", "qv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        own = own.select("query_id", "chunk_id", "lex", F.coalesce(F.round(dot, 6), F.lit(0.0)).alias("dense"))
        own = own.join(fused.select("query_id", F.col("id").alias("chunk_id"), "rrf"), ["query_id", "chunk_id"], "left")
        for name, frame, score in (("bl", lexical, "score"), ("bd", dense, "score"), ("bf", fused, "rrf")):
            own = own.join(frame.groupBy("query_id").agg(F.max(score).alias(name)), "query_id", "left")
        gap = lambda s, b: F.round(R.gap(F.coalesce(s, F.lit(0.0)), F.coalesce(b, F.lit(0.0))), 6)
        return own.select("query_id", "chunk_id", gap(F.col("lex"), F.col("bl")).alias("lex_gap"), gap(F.col("dense"), F.col("bd")).alias("dense_gap"), gap(F.col("rrf"), F.col("bf")).alias("fused_gap"))


def task_gaps(gaps: DataFrame, group: str) -> DataFrame:
    """(query_id, gap): the highest, over the groups of a task, of the lowest fused gap in the group."""
    return gaps.groupBy("query_id", group).agg(F.min("fused_gap").alias("g")).groupBy("query_id").agg(F.max("g").alias("gap"))


def broad(hits: DataFrame, gold: DataFrame) -> DataFrame:
    """(query_id, n_gold, n_hit, passed): a question is broad if its whole text doesn't reach all of its gold."""
    found = hits.select("query_id", F.col("id").alias("chunk_id"), F.lit(1).alias("hit"))
    by = gold.select("query_id", "chunk_id").distinct().join(found, ["query_id", "chunk_id"], "left").groupBy("query_id").agg(F.count("*").alias("n_gold"), F.count("hit").alias("n_hit"))
    return by.withColumn("passed", F.col("n_hit") < F.col("n_gold"))


def reached(hits: DataFrame, facts: DataFrame) -> DataFrame:
    """(query_id, passed): every gold chunk of facts (fact_id, query_id, chunk_id) is among the hits of one of its facts."""
    found = hits.select(F.col("query_id").alias("fact_id"), F.col("id").alias("chunk_id"), F.lit(True).alias("hit"))
    by = facts.join(found, ["fact_id", "chunk_id"], "left").groupBy("query_id", "chunk_id").agg(F.max(F.coalesce("hit", F.lit(False))).alias("ok"))
    return by.groupBy("query_id").agg(F.min("ok").alias("passed"))


def ambiguous(hits: DataFrame, gold: DataFrame, files: DataFrame, twins: DataFrame, band: float = 0.85, score: str = "score") -> DataFrame:
    """(query_id, referents, passed): a descriptor is ambiguous if its best gold chunk lies in the band below the best hit, and
    the band holds chunks of two documents, where a document in twins (query_id, file_name), near copies of the gold, doesn't count."""
    best = hits.groupBy("query_id").agg(F.max(score).alias("best"))
    inside = hits.join(best, "query_id").where((F.col(score) >= band * F.col("best")) & (F.col("best") > 0)).select("query_id", F.col("id").alias("chunk_id"))
    placed = inside.join(files, "chunk_id").join(twins, ["query_id", "file_name"], "left_anti")
    own = inside.join(gold.select("query_id", "chunk_id"), ["query_id", "chunk_id"]).select("query_id", F.lit(True).alias("gold")).distinct()
    by = placed.groupBy("query_id").agg(F.count_distinct("file_name").alias("referents"))
    out = best.join(by, "query_id", "left").join(own, "query_id", "left")
    n = F.coalesce("referents", F.lit(0))
    return out.select("query_id", n.alias("referents"), ((n >= 2) & F.coalesce("gold", F.lit(False))).alias("passed"))
