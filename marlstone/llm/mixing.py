"""Mixing sources to target weights by capped water-filling.

Every source has a size (characters), a target weight and a cap of max_epochs times its size. The total is poured over
the sources in proportion to their weights; a source that would pass its cap is clamped there, and what it leaves over
is poured again over the rest in proportion to their weights, until no source passes its cap. Sorted by cap / weight,
the clamped sources are a prefix, so the level comes from running sums over the table of sources. A document is then
repeated floor(epochs) times, and once more if its seeded hash falls below the fraction.

Defined cases
* size is n_chars; a null or negative n_chars counts as 0. A source of size 0 gets 0 epochs.
* A null source is a source of its own. Sources missing from given weights get weight 0, hence 0 epochs.
* total is total_ratio times the size of the corpus, and never more than all caps together.
* Rows equal in doc_id draw alike: the draw depends on doc_id and seed only. A null doc_id draws as the word null.
* An empty table gives an empty result. Other columns are ignored (mix_sources) or passed through (sample_mixture).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, stash, unit_hash

SEED = 17


def source_epochs(docs: DataFrame, weights: dict[str, float] | None = None, max_epochs: float = 3.0, total_ratio: float = 1.0) -> DataFrame:
    """(s, epochs) by source. weights None: the square root of each source's size."""
    size = F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)).cast("long")
    sizes = docs.select(F.col("source").alias("s"), size.alias("z")).groupBy("s").agg(F.sum("z").alias("z"))
    if weights is None:
        w = F.sqrt(F.col("z").cast("double"))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        w = F.coalesce(F.create_map(*pairs)[F.col("s")], F.lit(0.0)) if pairs else F.lit(0.0)
    every = Window.partitionBy()
    live = sizes.withColumn("w", w).withColumn("w", F.when(F.col("z") > 0, F.greatest("w", F.lit(0.0))).otherwise(0.0))
    live = live.withColumn("cap", F.when(F.col("w") > 0, F.col("z") * F.lit(float(max_epochs))).otherwise(0.0))
    live = live.withColumn("t", F.least(F.sum("z").over(every) * F.lit(float(total_ratio)), F.sum("cap").over(every)))
    live = live.withColumn("q", F.when(F.col("w") > 0, F.col("cap") / F.col("w")))
    order = Window.orderBy(F.asc_nulls_last("q"), F.asc_nulls_first("s"))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    live = live.withColumn("lam", F.when(F.col("w") > 0, (F.col("t") - before) / rest))
    # Up to the first source below its cap the level rises with every clamp; behind that one it only falls.
    level = F.max(F.when(F.col("q") > F.col("lam"), F.col("lam"))).over(every)
    amount = F.least("cap", F.coalesce(level * F.col("w"), F.col("cap")))
    epochs = F.when((F.col("z") > 0) & (F.col("w") > 0), F.round(amount / F.col("z"), 9)).otherwise(0.0)
    return live.select("s", epochs.alias("epochs"))


def _copies(docs: DataFrame, seed: int, **how) -> DataFrame:
    epochs = broadcast_if_small(stash(source_epochs(docs, **how), "epochs"))
    rows = docs.select(F.struct("*").alias("r"))
    joined = rows.join(epochs, F.col("r.source").eqNullSafe(F.col("s")))
    whole = F.floor("epochs")
    extra = F.when(unit_hash(F.col("r.doc_id"), seed) < F.round(F.col("epochs") - whole, 9), 1).otherwise(0)
    return joined.select("r", "epochs", (whole + extra).cast("long").alias("copies"))


def mix_sources(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """(doc_id, source, epochs, copies): how often each document enters the mixture, 0 included."""
    narrow = docs.select("doc_id", "source", "n_chars")
    return _copies(narrow, seed, **how).select("r.doc_id", "r.source", "epochs", "copies")


def sample_mixture(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """docs with every row repeated as often as it enters the mixture; the columns stay the same."""
    rows = _copies(docs, seed, **how).where("copies > 0").select("r", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("i"))
    return rows.select(*[F.col("r")[c].alias(c) for c in docs.columns])


SQL = f"""
WITH sizes AS (SELECT source AS s, CAST(sum(greatest(coalesce(n_chars, 0), 0)) AS BIGINT) AS z FROM documents GROUP BY source),
w AS (SELECT s, z, sqrt(CAST(z AS DOUBLE)) AS w, z * 3.0::DOUBLE AS cap FROM sizes),
q AS (SELECT *, least((sum(z) OVER ())::DOUBLE, sum(cap) OVER ()) AS t, CASE WHEN w > 0 THEN cap / w END AS q FROM w),
l AS (SELECT *, CASE WHEN w > 0 THEN (t - coalesce(sum(cap) OVER (ORDER BY q NULLS LAST, s NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY q NULLS LAST, s NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS lam FROM q),
e AS (SELECT s, CASE WHEN z > 0 THEN round(least(cap, coalesce((SELECT max(lam) FROM l WHERE q > lam) * w, cap)) / z, 9) ELSE 0.0 END AS epochs FROM l)
SELECT d.doc_id, d.source, e.epochs,
  CAST(floor(e.epochs) AS BIGINT) + CASE WHEN ('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 8))::UBIGINT / 4294967296.0::DOUBLE
    < round(e.epochs - floor(e.epochs), 9) THEN 1 ELSE 0 END AS copies
FROM documents d JOIN e ON d.source IS NOT DISTINCT FROM e.s
"""
