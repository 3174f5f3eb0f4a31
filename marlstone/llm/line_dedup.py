"""Line dedup: the first occurrence of every line in the corpus is kept, as one compressed bitmap per document.

Each line becomes two 64-bit hashes with different seeds, 128 bits in all, with its document and position. A task leaves only its first
row for a hash (of about COMBINE rows at a time), so a line in every document costs a few rows a task. The hashes are
range-partitioned, sorted within each partition by document and position, and the first row of every run of
equal hashes streams out. No text is shuffled.

Defined cases
* The order of first occurrence is (doc_id, position), null doc_id first. Documents that share a doc_id but differ in
  text count as separate documents, ordered by text hash; rows equal in doc_id and text yield one result row.
* Blank lines (nothing but spaces) shape the text and are always kept.
* A null text has 0 lines and the empty bitmap; an empty text has one blank line, kept.
* keep_bitmap is the run-length form of the bitmap: counts of dropped and kept lines in turn, dropped first
  ("0,3,2,1" = keep 3, drop 2, keep 1).
* Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stash

COMBINE = 1 << 19


def _runs(kept, n):
    """The run lengths of a sorted array of kept positions; kept has to be a plain column."""
    starts = F.filter(kept, lambda x, i: (i == 0) | (F.get(kept, i - 1) < x - 1))
    ends = F.filter(kept, lambda x, i: (i == F.size(kept) - 1) | (F.get(kept, i + 1) > x + 1))
    pieces = let(
        ends,
        lambda es: F.transform(
            starts,
            lambda s, j: F.concat_ws(
                ",",
                (s - F.when(j == 0, F.lit(0)).otherwise(F.get(es, j - 1) + 1)).cast("string"),
                (F.get(es, j) - s + 1).cast("string"),
            ),
        ),
    )
    tail = n - F.coalesce(F.get(kept, F.size(kept) - 1) + 1, F.lit(0))
    return F.concat_ws(",", F.array_join(pieces, ","), F.when(tail > 0, tail.cast("string")))


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row in (d, v, p) for each (h, g) of about COMBINE rows at a time."""
    order = [("h", "ascending"), ("g", "ascending"), ("d", "ascending"), ("v", "ascending"), ("p", "ascending")]

    def out(held):
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start"))
        h, g = table.column("h").to_numpy(), table.column("g").to_numpy()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        yield from table.filter(pa.array(new)).to_batches()

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= COMBINE:
            yield from out(held)
            held, rows = [], 0
    if rows:
        yield from out(held)


def line_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_kept, keep_bitmap), one row per document."""
    return _bitmaps(docs).select("doc_id", "n_lines", "n_kept", "keep_bitmap")


def _bitmaps(docs: DataFrame) -> DataFrame:
    base = docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t"))
    base = base.select("d", F.xxhash64("t").alias("v"), F.split("t", "\n", -1).alias("ls"))
    line = F.col("l")
    blank = F.length(F.trim(line)) == 0
    lines = base.select("d", "v", F.posexplode("ls").alias("p", "l")).select(
        "d",
        "v",
        "p",
        F.when(blank, F.xxhash64("d", "v", "p")).otherwise(F.xxhash64(line)).alias("h"),
        F.when(blank, F.xxhash64("p", "v", "d")).otherwise(F.xxhash64(F.lit(1), line)).alias("g"),
    )
    # The range bounds come from a sample of their own, so what is to be partitioned is written once.
    first = stash(lines.mapInArrow(_firsts, lines.schema), "lines")
    ranged = first.repartitionByRange("h", "g")
    order = Window.partitionBy("h", "g").orderBy(F.asc_nulls_first("d"), "v", "p")
    firsts = ranged.withColumn("rn", F.row_number().over(order)).where("rn = 1")

    counts = base.select("d", "v", F.when(F.col("ls").isNull(), 0).otherwise(F.size("ls")).alias("n"), F.lit(None).cast("int").alias("p"))
    by_doc = (
        counts.unionByName(firsts.select("d", "v", F.lit(None).cast("int").alias("n"), "p"))
        .groupBy("d", "v")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list("p")).alias("kept"))
    )
    bitmap = _runs(F.col("kept"), F.col("n"))
    whole = F.size("kept") == F.col("n")
    text = F.when(F.size("kept") == 0, F.when(F.col("n") > 0, F.col("n").cast("string")).otherwise("")).when(whole, F.concat(F.lit("0,"), F.col("n").cast("string"))).otherwise(bitmap)
    return by_doc.select(
        F.col("d").alias("doc_id"),
        "v",
        F.col("n").cast("long").alias("n_lines"),
        F.size("kept").cast("long").alias("n_kept"),
        text.alias("keep_bitmap"),
    )


def keep_flags(bitmap):
    """The bitmap column as an array of booleans, one for each line."""
    runs = F.split(bitmap, ",")
    return F.flatten(F.transform(F.when(F.length(bitmap) > 0, runs).otherwise(F.array().cast("array<string>")), lambda c, i: F.array_repeat(i % 2 == 1, c.cast("int"))))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines taken out of text and n_chars set to its new length.

    Documents of which no line that isn't blank stays are dropped. Rows equal in doc_id and text are one document: each
    of them stays or goes, with the same text. A null or blank text is passed through. Columns other than text and n_chars are passed through unchanged.
    """
    bitmaps = _bitmaps(docs).select(F.col("doc_id").alias("d"), "v", F.col("n_lines").alias("n"), F.col("n_kept").alias("k"), F.col("keep_bitmap").alias("b"))
    rows = docs.select(F.struct("*").alias("r"))
    joined = rows.join(bitmaps, F.col("r.doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("r.text") == F.col("v")), "left")
    flags = keep_flags(F.col("b"))
    lines = F.split(F.col("r.text"), "\n", -1)
    kept = F.transform(F.filter(F.arrays_zip(lines.alias("l"), flags.alias("f")), lambda x: x["f"]), lambda x: x["l"])
    text = F.when(F.col("k") == F.col("n"), F.col("r.text")).otherwise(F.array_join(kept, "\n"))
    out = joined.select("r", "n", "k", text.alias("t"))
    blank = F.coalesce(F.length(F.trim(F.translate(F.col("t"), "\n", " "))), F.lit(0)) == 0
    out = out.where(~((F.col("k") < F.col("n")) & blank))
    new = {"text": F.col("t"), "n_chars": F.length("t").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[new[c].alias(c) if c in new else F.col("r")[c].alias(c) for c in docs.columns])


SQL = """
WITH lines AS (
  SELECT d.doc_id, u.p, string_split(d.text, chr(10))[u.p + 1] AS l
  FROM documents d, LATERAL (SELECT unnest(range(len(string_split(d.text, chr(10))))) AS p) u),
ranked AS (
  SELECT doc_id, p, CASE WHEN length(trim(l)) = 0 OR row_number() OVER (PARTITION BY l ORDER BY doc_id NULLS FIRST, p) = 1 THEN 1 ELSE 0 END AS keep
  FROM lines),
islands AS (
  SELECT doc_id, p, keep, row_number() OVER (PARTITION BY doc_id ORDER BY p) - row_number() OVER (PARTITION BY doc_id, keep ORDER BY p) AS g
  FROM ranked),
runs AS (SELECT doc_id, keep, g, min(p) AS s, count(*) AS n FROM islands GROUP BY doc_id, keep, g),
maps AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n * keep) AS BIGINT) AS n_kept,
    (CASE WHEN min_by(keep, s) = 1 THEN '0,' ELSE '' END) || string_agg(CAST(n AS VARCHAR), ',' ORDER BY s) AS keep_bitmap
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_kept, 0) AS n_kept, coalesce(m.keep_bitmap, '') AS keep_bitmap
FROM documents d LEFT JOIN maps m ON d.doc_id = m.doc_id
"""
