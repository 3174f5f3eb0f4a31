"""Entities, their statistics and the pairs of chunks that they bridge; density; selection and splits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .nearest import TILE
from .retrieval import block_products, past_vectors

PATTERNS = (("quoted", "[«\"]([^«»\"]{2,60})[»\"]", 1), ("code", r"[A-Z]{2,}-?[0-9]{1,6}", 0), ("date", r"[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}", 0), ("amount", r"[0-9]{4,}", 0), ("proper", r"\p{Lu}\p{Ll}{2,}", 0))


def _matches(order: int, name: str, pattern: str, group: int) -> Column:
    found = F.regexp_extract_all(F.col("raw_text"), F.lit(pattern), F.lit(group))
    return F.transform(found, lambda s: F.struct(F.lower(F.trim(s)).alias("entity"), F.lit(order).alias("o"), F.lit(name).alias("type")))


def mentions(chunks: DataFrame) -> DataFrame:
    """(entity, type, chunk_id), once for each chunk; an entity that two patterns find keeps the type of the first."""
    found = [_matches(i, *pattern) for i, pattern in enumerate(PATTERNS)]
    each = chunks.select("chunk_id", F.explode(F.concat(*found)).alias("e")).select("chunk_id", "e.*")
    return each.groupBy("entity", "chunk_id").agg(F.min_by("type", "o").alias("type"))


def entity_idf(chunks: DataFrame) -> DataFrame:
    """(entity, df, idf) with idf = ln(N / df), N all chunks."""
    n = chunks.agg(F.count("*").alias("n"))
    df = mentions(chunks).groupBy("entity").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("entity", "df", F.round(F.log(F.col("n") / F.col("df")), 6).alias("idf"))  # n is one row


def nearest_rank(values: DataFrame, value: str, p: float) -> DataFrame:
    """The value at rank rint(p (n - 1)) of the sorted values, by counting distinct values rather than sorting rows."""
    counts = values.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    run = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    total = counts.agg(F.sum("c").alias("n"))
    placed = counts.withColumn("upto", F.sum("c").over(run)).crossJoin(F.broadcast(total))  # total is one row
    return placed.where(F.col("upto") > F.rint(F.lit(p) * (F.col("n") - 1))).agg(F.min("v").alias("threshold"), F.max("n").alias("n"))


def bridges(chunks: DataFrame, scope: Column, min_co: int = 2, max_df: int = 40) -> DataFrame:
    """(scope, entity, a, b): chunks of different files in one scope that share an entity of at most max_df chunks in all."""
    m = mentions(chunks).select("entity", "chunk_id")
    rare = m.groupBy("entity").agg(F.count("*").alias("df")).where(F.col("df").between(min_co, max_df)).select("entity")
    where = chunks.select("chunk_id", "file_name", scope.alias("scope"))
    placed = m.join(rare, "entity").join(where, "chunk_id")
    left = placed.select("scope", "entity", F.col("chunk_id").alias("a"), F.col("file_name").alias("fa"))
    right = placed.select("scope", "entity", F.col("chunk_id").alias("b"), F.col("file_name").alias("fb"))
    return left.join(right, ["scope", "entity"]).where("a < b AND fa <> fb").select("scope", "entity", "a", "b")


def _slack(q: np.ndarray, c: np.ndarray) -> float:
    """How far a product of rows in single precision may be from the rounded one."""
    longest = [np.sqrt(np.einsum("ij,ij->i", x, x).max()) for x in (q, c)]
    return (q.shape[1] + 64) * 2.0**-23 * longest[0] * longest[1] + 1e-6


def _exact(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray, size: int = 8192) -> np.ndarray:
    """The products of rows i of q and j of c, rounded to 6 places."""
    out = np.empty(len(i))
    for s in range(0, len(i), size):
        out[s : s + size] = np.einsum("ij,ij->i", q[i[s : s + size]], c[j[s : s + size]])
    return np.round(out, 6) + 0.0


def pair_similarities(vectors: DataFrame, scope: str | None = None, least: float = -2.0, value: str | None = None) -> DataFrame:
    """(a, b, sim, va, vb) for all pairs a < b at least that similar, within a scope if one is named, with a column of both as va
    and vb if it is named: block products, of which only those pairs leave."""

    def run(one, other):
        (a, qs, va, q), (b, cs, vb, c) = one, other
        if least > -2.0:  # products in single precision tell which pairs may reach it
            i, j = np.nonzero(q.astype(np.float32) @ c.astype(np.float32).T >= np.float32(least - _slack(q, c)))
            ok = (a[i] < b[j]) & (qs[i] == cs[j] if scope else True)
        else:
            ok = a[:, None] < b[None, :]
            i, j = np.nonzero(ok & (qs[:, None] == cs[None, :]) if scope else ok)
            ok = slice(None)
        i, j = i[ok], j[ok]
        s = _exact(q, c, i, j)
        near = s >= least
        i, j, s = i[near], j[near], s[near]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[i], b[j], s, va[i], vb[j])], names=["a", "b", "sim", "va", "vb"])

    some = vectors.where(F.col(scope).isNotNull()) if scope else vectors
    pairs = block_products(some, some, run, "a long, b long, sim double, va double, vb double", scope, value)
    return pairs if value else pairs.drop("va", "vb")


def shape_sample(vectors: DataFrame, size: int = 600, seed: str = "shape") -> DataFrame:
    """(a, b, sim) for all pairs a < b of a drawn sample of vectors."""
    return pair_similarities(vectors.select("id", "vec", T.unit(F.col("id"), seed).alias("u")).orderBy("u", "id").limit(size))


def similarity_shape(pairs: DataFrame) -> DataFrame:
    ps = [F.round(F.percentile("sim", F.lit(p)), 6).alias(f"p{round(p * 100)}") for p in (0.5, 0.8, 0.95, 0.99)]
    return pairs.agg(F.count("*").alias("n_pairs"), F.round(F.avg("sim"), 6).alias("mean"), F.round(F.stddev_pop("sim"), 6).alias("sd"), *ps)


def density(vectors: DataFrame, tau: float) -> DataFrame:
    """(id, density): how many others lie nearer than tau, 0 included; all vectors stream past a part of them at a time, and only
    counts leave. Products in single precision tell on which side of tau a pair is, but for the few that are close to it."""

    def run(ids, q, marks):
        order = np.argsort(ids, kind="stable")
        q32, known = q.astype(np.float32), ids[order]

        def step(own, c, mark):
            c32, slack, n = c.astype(np.float32), _slack(q, c), np.zeros(len(own), np.int64)
            lo, hi = (np.searchsorted(known, own, side) for side in ("left", "right"))
            same = np.repeat(np.arange(len(own)), hi - lo)  # rows that are held themselves, and where
            held = order[np.arange(len(same)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[same]]
            for s in range(0, len(q), TILE):
                x = c32 @ q32[s : s + TILE].T
                here = (held >= s) & (held < s + TILE)
                x[same[here], held[here] - s] = -np.inf
                sure, may = x > np.float32(tau + slack), x >= np.float32(tau - slack)
                n += np.bitwise_count(np.packbits(sure, axis=1)).sum(axis=1, dtype=np.int64)
                i, j = np.divmod(np.flatnonzero(sure != may), x.shape[1])
                n += np.bincount(i[_exact(c, q[s : s + TILE], i, j) > tau], minlength=len(own))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], names=["id", "n"])

        return step

    return past_vectors(vectors, run, "id long, n long").groupBy("id").agg(F.sum("n").alias("density"))


def best_by_group(vectors: DataFrame, group: str) -> DataFrame:
    """(g, donor, best): for every group, a hash of the column, and every vector outside it, its highest similarity to a member.
    All vectors stream past a part of them, sorted by group, at a time; only the highest of each group leaves."""

    def run(ids, q, marks):
        order = np.argsort(marks, kind="stable")
        q, marks = q[order], marks[order]

        def step(own, c, mark):
            held = None  # the group that a tile leaves open, and its best so far
            for s in range(0, len(q), TILE):
                part = marks[s : s + TILE]
                first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                top, groups = np.maximum.reduceat(q[s : s + TILE] @ c.T, first, axis=0), part[first]
                if held and held[0] == groups[0]:
                    top[0] = np.maximum(top[0], held[1])
                elif held:
                    top, groups = np.vstack([held[1], top]), np.append(held[0], groups)
                if s + TILE < len(q):
                    held, top, groups = (groups[-1], top[-1].copy()), top[:-1], groups[:-1]
                if len(groups):
                    i, j = np.nonzero(groups[:, None] != mark[None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(groups[i]), pa.array(own[j]), pa.array(np.round(top[i, j], 6) + 0.0)], names=["g", "donor", "best"])

        return step

    return past_vectors(vectors, run, "g long, donor long, best double", group).groupBy("g", "donor").agg(F.max("best").alias("best"))


def kth_similarity(top: DataFrame, k: int) -> DataFrame:
    """(id, kth) from ranked neighbours."""
    return top.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))


def stratified_holdout(rows: DataFrame, stratum: str, size: int, seed: str = "h") -> DataFrame:
    """(id, stratum, split): strata give rows in turn, larger ones first, each in a drawn order, until size are held out.

    A row's place in that order follows from its turn within the stratum and the sizes of all strata, a table of a row
    per stratum; no sort goes over all rows.
    """
    drawn = Window.partitionBy(stratum).orderBy(T.unit(F.col("id"), seed), "id")
    n = rows.groupBy(stratum).agg(F.count("*").alias("n"))
    order = n.withColumn("so", F.row_number().over(Window.orderBy(F.desc("n"), stratum)))
    every = order.agg(F.collect_list(F.struct("so", "n")).alias("strata"))
    placed = rows.withColumn("turn", F.row_number().over(drawn)).join(F.broadcast(order.select(stratum, "so")), stratum).crossJoin(F.broadcast(every))
    before = F.aggregate("strata", F.lit(0).cast("long"), lambda t, x: t + F.least(F.col("turn").cast("long") - 1, x["n"]))
    within = F.size(F.filter("strata", lambda x: (x["so"] <= F.col("so")) & (x["n"] >= F.col("turn"))))
    return placed.select("id", stratum, F.when(before + within <= size, "holdout").otherwise("train").alias("split"))


def duplicate_sets(sets: DataFrame) -> DataFrame:
    """(members, n, keep) of equal sets of (id, member) rows; keep is the lowest id."""
    by = sets.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("member")).cast("array<string>"), ",").alias("members"))
    return by.groupBy("members").agg(F.count("*").alias("n"), F.min("id").alias("keep")).where("n > 1")


def overlap_share(sets: DataFrame) -> DataFrame:
    """Ids that share a member with another id, among all."""
    shared = sets.dropDuplicates(["id", "member"]).withColumn("c", F.count("*").over(Window.partitionBy("member")))
    by = shared.groupBy("id").agg(F.max(F.col("c") > 1).alias("x"))
    return by.agg(F.count("*").alias("n"), F.sum(F.col("x").cast("long")).alias("overlapping"))
