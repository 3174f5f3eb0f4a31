"""Mining of subgraphs: scopes, bridging entities within them, extension, emission under quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def scope_groups(chunks: DataFrame, scope: Column, least: int) -> DataFrame:
    """(chunk_id, scope, n, residue): chunks by scope; those without a scope, or in one of fewer than least chunks, are residue."""
    placed = chunks.select("chunk_id", scope.alias("scope"))
    n = placed.groupBy("scope").agg(F.count("*").alias("n"))
    return placed.join(n, "scope").select("chunk_id", "scope", "n", ((F.col("scope") == "") | (F.col("n") < least)).alias("residue"))


def scope_bridges(mentions: DataFrame, where: DataFrame, total: int, min_co: int = 2, ratio: float = 0.3, max_df: int = 40, least_idf: float = 1.0, per_entity: int = 3) -> DataFrame:
    """(scope, entity, idf, a, b, turn, place): pairs of chunks from different files of a scope that share an entity, which occurs
    in the scope in min_co to max(min_co, ratio x its chunks) chunks, and overall in at most max_df; an entity gives
    per_entity pairs, and entities take turns, the rarest first.

    mentions (entity, chunk_id); where (chunk_id, file_name, scope). max_df bounds the pairs of an entity: it defines what a bridge is.
    """
    df = mentions.groupBy("entity").agg(F.count("*").alias("df")).withColumn("idf", F.round(F.log(F.lit(float(total)) / F.col("df")), 6))
    rare = df.where((F.col("df") <= max_df) & (F.col("idf") >= least_idf)).select("entity", "idf")
    placed = mentions.select("entity", "chunk_id").join(rare, "entity").join(where, "chunk_id")
    sizes = where.groupBy("scope").agg(F.count("*").alias("n"))
    local = placed.groupBy("scope", "entity").agg(F.count("*").alias("c")).join(sizes, "scope")
    good = local.where((F.col("c") >= min_co) & (F.col("c") <= F.greatest(F.lit(min_co), F.floor(F.col("n") * ratio)))).select("scope", "entity")
    kept = placed.join(good, ["scope", "entity"])
    left = kept.select("scope", "entity", "idf", F.col("chunk_id").alias("a"), F.col("file_name").alias("fa"))
    right = kept.select("scope", "entity", F.col("chunk_id").alias("b"), F.col("file_name").alias("fb"))
    pairs = left.join(right, ["scope", "entity"]).where("a < b AND fa <> fb")
    pairs = pairs.withColumn("turn", F.row_number().over(Window.partitionBy("scope", "entity").orderBy("a", "b")).cast("long")).where(F.col("turn") <= per_entity)
    place = F.row_number().over(Window.partitionBy("scope").orderBy("turn", F.desc("idf"), "entity"))
    return pairs.withColumn("place", place.cast("long")).select("scope", "entity", "idf", "a", "b", "turn", "place")


def bridge_entities(subgraphs: DataFrame, mentions: DataFrame, idf: DataFrame, top: int = 6) -> DataFrame:
    """(sg, entity, members, rank): the entities that two members of a subgraph (sg, chunk_id) share, the rarest first, up to top."""
    by = subgraphs.join(mentions.select("entity", "chunk_id"), "chunk_id").groupBy("sg", "entity").agg(F.count("*").alias("members")).where("members > 1")
    best = Window.partitionBy("sg").orderBy(F.desc("idf"), "entity")
    return by.join(idf.select("entity", "idf"), "entity").withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top).select("sg", "entity", "members", "rank")


def extend(subgraphs: DataFrame, mentions: DataFrame, where: DataFrame, rare: DataFrame, gap: int = 2) -> DataFrame:
    """(sg, chunk_id): the chunk that joins each pair (sg, scope, a, b, entity): of its scope, sharing another rare entity with a
    member, from a new file or at least gap chunks away from the members of its own; new files first, then as drawn."""
    member = subgraphs.select("sg", "scope", "entity", F.explode(F.array("a", "b")).alias("m"))
    held = mentions.select("entity", "chunk_id").join(rare.select("entity"), "entity").join(where, "chunk_id")
    via = member.join(held.select(F.col("chunk_id").alias("m"), F.col("entity").alias("other")), "m").where("other <> entity").select("sg", "scope", "other").distinct()
    near = via.join(held.select(F.col("entity").alias("other"), "scope", "chunk_id", "file_name", "idx"), ["other", "scope"]).select("sg", "chunk_id", "file_name", "idx").distinct()
    at = where.select(F.col("chunk_id").alias("m"), F.col("file_name").alias("mf"), F.col("idx").alias("mi"))
    both = near.join(member.select("sg", "m").join(at, "m"), "sg")
    same = F.col("file_name") == F.col("mf")
    ok = (F.col("chunk_id") != F.col("m")) & (~same | (F.abs(F.col("idx") - F.col("mi")) >= gap))
    each = both.groupBy("sg", "chunk_id").agg(F.min(ok).alias("ok"), F.max(same).alias("seen")).where("ok")
    draw = T.unit(F.concat_ws("|", "sg", "chunk_id"), "extend")
    best = Window.partitionBy("sg").orderBy("seen", draw, "chunk_id")
    return each.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("sg", "chunk_id")


def emit(rows: DataFrame, scope: str, order: list, quota: int, target: int) -> DataFrame:
    """rows of each scope in turn, one a pass, at most quota of a scope and target in all: with the place of each."""
    turn = rows.withColumn("pass", F.row_number().over(Window.partitionBy(scope).orderBy(*order)).cast("long")).where(F.col("pass") <= quota)
    first = turn.orderBy("pass", scope).limit(target)
    return first.withColumn("place", F.row_number().over(Window.orderBy("pass", scope)).cast("long"))  # target rows
