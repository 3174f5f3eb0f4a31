"""Chunks: eligibility, neighbour windows, packed units, boundaries, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def eligible(text: Column, min_chars: int = 200, max_chars: int = 4000, min_words: int = 25, min_letters: float = 0.5, min_script: float = 0.3, script: str = r"\p{IsLatin}") -> Column:
    """Whether a chunk may seed a window. The cheap tests come first; the regular expressions run on what is left."""
    return F.length(text).between(min_chars, max_chars) & (T.n_words(text) >= min_words) & (T.letter_ratio(text) >= min_letters) & (T.script_ratio(text, script) >= min_script)


def neighbour_windows(chunks: DataFrame, max_chars: int = 9000, per_file: int = 6, seed: str = "w") -> DataFrame:
    """Runs of 2 to 4 neighbouring chunks from eligible seeds. One sort by (file, index) yields lengths and gaps of all
    sizes; the cap per file takes seeds in a drawn order."""
    line = Window.partitionBy("file_name").orderBy("idx")
    ok = chunks.withColumn("n", F.length("raw_text")).withColumn("ok", eligible(F.col("raw_text")))
    for k in (1, 2, 3):
        ok = ok.withColumn(f"i{k}", F.lead("idx", k).over(line)).withColumn(f"n{k}", F.lead("n", k).over(line))
    run = F.when(F.col("i3") == F.col("idx") + 3, 4).when(F.col("i2") == F.col("idx") + 2, 3).when(F.col("i1") == F.col("idx") + 1, 2)
    u = T.unit(F.col("chunk_id"), seed)
    want = F.when(u < 0.5, 2).when(u < 0.85, 3).otherwise(4)
    size = F.least(want, run)
    total = lambda m: sum((F.when(m > k, F.col(f"n{k}")).otherwise(0) for k in (1, 2, 3)), F.col("n"))
    sized = ok.where("ok AND i1 = idx + 1").withColumn("m", size)
    sized = sized.withColumn("m", F.when((total(F.col("m")) > max_chars) & (F.col("m") > 2), 2).otherwise(F.col("m"))).withColumn("n_chars", total(F.col("m"))).where(F.col("n_chars") <= max_chars)
    drawn = Window.partitionBy("file_name").orderBy(T.unit(F.col("chunk_id"), seed + "o"), "idx")
    kept = sized.withColumn("rn", F.row_number().over(drawn)).where(F.col("rn") <= per_file)
    indices = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1), lambda k: F.col("idx") + k), ", ")
    return kept.select(
        F.concat(F.lit("w_"), F.substring(F.sha1(F.concat(F.col("file_name"), F.lit("|["), indices, F.lit("]"))), 1, 12)).alias("window_id"),
        "file_name",
        indices.alias("indices"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def packed_units(chunks: DataFrame, max_chars: int = 3000, max_chunks: int = 8) -> DataFrame:
    """Greedy spans of a file's chunks: one closes when the next chunk would pass max_chars, or at max_chunks. The fold
    over a file's (index, length) pairs carries only the spans' starts."""
    sizes = chunks.groupBy("file_name").agg(F.array_sort(F.collect_list(F.struct("idx", F.length("raw_text").alias("n")))).alias("xs"))
    start = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).alias("count"), F.array().cast("array<long>").alias("cuts"))

    def step(s, x):
        close = (s["count"] > 0) & ((s["chars"] + x["n"] > max_chars) | (s["count"] >= max_chunks))
        fresh = close | (s["count"] == 0)
        return F.struct(
            F.when(fresh, x["n"].cast("long")).otherwise(s["chars"] + x["n"]).alias("chars"),
            F.when(fresh, 1).otherwise(s["count"] + 1).alias("count"),
            F.when(fresh, F.concat(s["cuts"], F.array(x["idx"]))).otherwise(s["cuts"]).alias("cuts"),
        )

    cuts = sizes.select("file_name", (F.size("xs") - 1).alias("last"), F.aggregate("xs", start, step)["cuts"].alias("cuts"))
    return cuts.select("file_name", "last", F.posexplode("cuts").alias("unit", "first"), "cuts").select(
        "file_name",
        F.col("unit").cast("long").alias("unit"),
        "first",
        (F.coalesce(F.get("cuts", F.col("unit") + 1) - 1, F.col("last").cast("long"))).alias("last"),
    )


def boundaries(chunks: DataFrame) -> DataFrame:
    t = F.col("raw_text")
    return chunks.where("raw_text <> ''").agg(
        F.count("*").alias("n_chunks"),
        F.countDistinct("file_name").alias("n_files"),
        F.round(F.avg(F.length(t)), 4).alias("mean_chars"),
        F.round(F.percentile(F.length(t), F.lit(0.5)), 4).alias("median_chars"),
        F.min(F.length(t)).cast("long").alias("min_chars"),
        F.max(F.length(t)).cast("long").alias("max_chars"),
        F.sum((~t.rlike("[.!?…»\"']$")).cast("long")).alias("open_ends"),
        F.sum(t.rlike(r"^\p{Ll}").cast("long")).alias("low_starts"),
    )


def checksum(chunks: DataFrame) -> DataFrame:
    """One hash of the corpus whatever its order: hashes add up per slice of the ids, the slices are hashed in order."""
    own = F.sha1(F.concat("chunk_id", T.content_hash(F.col("raw_text"))))
    slices = chunks.select(F.substring(own, 1, 2).alias("s"), F.conv(F.substring(own, 3, 10), 16, 10).cast("decimal(38,0)").alias("v"))
    sums = slices.groupBy("s").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    return sums.agg(F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "v", "n"))), lambda x: F.concat_ws(":", x["s"], x["v"].cast("string"), x["n"].cast("string"))), ",")).alias("checksum"), F.sum("n").alias("n_chunks"))
