"""Stage control: decision logs, signed indexes, final records, reports; verdicts that depend on an outside judge."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import checksum


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def decide(todo: DataFrame, log: DataFrame, key: str, ok: Column, reason: Column) -> DataFrame:
    """(key, outcome) of the rows that the log, of passes and rejects alike, doesn't have: 'pass', or the reason."""
    new = todo.join(log.select(key).distinct(), key, "left_anti")
    return new.select(key, F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise(reason).alias("outcome"))


def survivors(rows: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """rows whose first decision is a pass."""
    return rows.join(log.where("outcome = 'pass'").select(key).distinct(), key, "left_semi")


def signature(chunks: DataFrame, **options) -> str:
    """What an index depends on: the corpus and every option of its making."""
    row = checksum(chunks).first()
    return hashlib.sha1(json.dumps([row["checksum"], row["n_chunks"], sorted(options.items())], default=str).encode()).hexdigest()[:16]


def load_or_build(spark: SparkSession, path: str, signed: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The index of that signature under a path, built and written first if there is none."""
    own = f"{path.rstrip('/')}/{signed}"
    if not exists(spark, f"{own}/_SUCCESS"):
        build().write.mode("overwrite").parquet(own)
    return spark.read.parquet(own)


def finalise(spark: SparkSession, stages: list[str]) -> DataFrame:
    """The records of the most downstream stage that was written; stages are paths of JSON, the last stage first. One that is
    there and empty is an error: what came before isn't final."""
    for path in stages:
        if exists(spark, path):
            rows = spark.read.json(path)
            if not rows.columns or rows.isEmpty():
                raise ValueError(f"{path} is empty")
            return rows
    raise FileNotFoundError(", ".join(stages))


def write_corpus(chunks: DataFrame, path: str, doc: str = "file_name") -> dict:
    """Chunks, a sidecar of each document and a manifest under a path; returns the manifest."""
    chunks.write.mode("overwrite").json(f"{path}/chunks")
    docs = chunks.groupBy(doc).agg(F.count("*").alias("n_chunks"), F.sum(F.length("raw_text")).alias("n_chars"))
    docs.write.mode("overwrite").json(f"{path}/documents")
    made = report(chunks, doc) | {"checksum": checksum(chunks).first()["checksum"]}
    chunks.sparkSession.createDataFrame([(json.dumps(made, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return made


def report(chunks: DataFrame, doc: str = "file_name") -> dict:
    """Counts and lengths of a corpus, one aggregation."""
    n = F.length("raw_text")
    row = chunks.agg(
        F.count("*").alias("chunks"),
        F.count_distinct(doc).alias("documents"),
        F.coalesce(F.sum(n), F.lit(0)).alias("chars"),
        F.round(F.avg(n), 4).alias("mean_chars"),
        F.round(F.percentile(n, F.lit(0.5)), 4).alias("median_chars"),
        F.sum(F.col("raw_text").rlike(r"^\p{Ll}").cast("int")).alias("low_starts"),
    ).first()
    return row.asDict()


def with_retries(call: Callable[[str], str], attempts: int = 3, wait: float = 0.5) -> Callable[[str], dict | None]:
    """A completion as a dictionary: an answer that holds no JSON object is asked for again once; a connection error is tried
    again and then leaves the row undecided (None), which is no verdict."""
    from .sequential import first_json

    def ask(prompt: str) -> dict | None:
        corrected = False
        for i in range(attempts):
            try:
                found = first_json(call(prompt))
            except (ConnectionError, TimeoutError):
                time.sleep(wait * 2**i)
                continue
            if found is not None:
                return json.loads(found)
            if corrected:
                return None
            prompt, corrected = f"{prompt}\nAnswer with one JSON object only.", True
        return None

    return ask


def judged(rows: DataFrame, prompt: Column, connect: Callable[[], Callable[[str], str]], attempts: int = 3, wait: float = 0.5) -> DataFrame:
    """rows with `verdict`, the JSON that a model gives for each prompt, or null if it could not be reached. connect() makes the
    client once for each task, where it is used."""
    asked = rows.withColumn("verdict", prompt)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = with_retries(connect(), attempts, wait)
        for batch in batches:
            answers = [None if p is None else ask(p) for p in batch["verdict"]]
            yield batch.assign(verdict=[None if a is None else json.dumps(a, ensure_ascii=False) for a in answers])

    return asked.mapInPandas(run, asked.schema)


def repaired(rows: DataFrame, text: str, flaws: Callable[[Column], Column], repair: Callable[[Column, Column], Column], attempts: int = 2) -> DataFrame:
    """rows with `problems` and `tries`: rows that fail are repaired and judged again, attempts times in all. Each round is one
    more projection; flaws gives the names of what is wrong, empty for nothing."""
    out = rows.withColumn("problems", flaws(F.col(text))).withColumn("tries", F.lit(1))
    for _ in range(attempts - 1):
        bad = F.col("problems") != ""
        out = out.withColumn("_bad", bad).withColumn(text, F.when(bad, repair(F.col(text), F.col("problems"))).otherwise(F.col(text)))
        out = out.withColumn("problems", F.when(F.col("_bad"), flaws(F.col(text))).otherwise(F.col("problems"))).withColumn("tries", F.col("tries") + F.col("_bad").cast("int")).drop("_bad")
    return out


def cascade(candidates: DataFrame, quota: int, budget: int, wave: int = 4) -> DataFrame:
    """(task, id, level, place): verified candidates (task, id, level, ord, ok) in the order of a cascade: up to quota of level 2,
    then level 1, the rest of level 2, level 3, until the budget of the task is used. Candidates of a level are tried in
    waves; two barren waves in a row retire it."""
    by = Window.partitionBy("task", "level").orderBy("ord", "id")
    waves = candidates.withColumn("wave", F.floor((F.row_number().over(by) - 1) / wave))
    barren = waves.groupBy("task", "level", "wave").agg((F.sum(F.col("ok").cast("int")) == 0).alias("barren"))
    after = Window.partitionBy("task", "level").orderBy("wave")
    ended = barren.withColumn("end", F.col("barren") & F.lag("barren", 1, False).over(after)).where("end").groupBy("task", "level").agg(F.min("wave").alias("last"))
    live = waves.join(ended, ["task", "level"], "left").where("ok AND (last IS NULL OR wave <= last)")
    rank = F.row_number().over(by)
    step = F.when((F.col("level") == 2) & (rank <= quota), 0).when(F.col("level") == 1, 1).when(F.col("level") == 2, 2).otherwise(3)
    placed = live.withColumn("step", step)
    at = Window.partitionBy("task").orderBy("step", "ord", "id")
    return placed.withColumn("place", F.row_number().over(at).cast("long")).where(F.col("place") <= budget).select("task", "id", "level", "place")


def reach_loss(before: DataFrame, after: DataFrame, key: str = "query_id") -> DataFrame:
    """(checked, lost, rate) of tasks reached before an injection and not after it."""
    j = before.where("passed").select(key).join(after.select(key, F.col("passed").alias("still")), key, "left")
    lost = F.sum((~F.coalesce("still", F.lit(False))).cast("long"))
    return j.agg(F.count("*").alias("checked"), F.coalesce(lost, F.lit(0)).alias("lost"), F.round(F.coalesce(lost, F.lit(0)) / F.greatest(F.count("*"), F.lit(1)), 4).alias("rate"))


def vetoes(facts: DataFrame, task: str, doc: str, weight: str, order: str) -> DataFrame:
    """facts with `verdict`: 'document' where a fact is its document's only one in the task, 'identifier' for the fact of the
    highest weight, which carries the identifier, else 'removable'."""
    own = F.count("*").over(Window.partitionBy(task, doc))
    best = F.row_number().over(Window.partitionBy(task).orderBy(F.desc(weight), order))
    return facts.withColumn("_n", own).withColumn("_b", best).withColumn("verdict", F.when(F.col("_n") == 1, "document").when(F.col("_b") == 1, "identifier").otherwise("removable")).drop("_n", "_b")


def densify(tasks: DataFrame, scope: str, order: str, density: str, goal: float, most: int) -> DataFrame:
    """(id, add): how many chunks each task injects to lift its density to goal, at most `most`, where what tasks before it in
    the scope injected counts for it too. The ordered tasks of a scope stream through one task, which holds their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, 0
        for batch in batches:
            adds = []
            for s, v in zip(batch.column("s").to_pylist(), batch.column("v").to_pylist()):
                if at is None or s != at[0]:
                    at, total = (s,), 0
                adds.append(0 if v is None else int(min(max(math.ceil(goal - v - total), 0), most)))
                total += adds[-1]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(adds, pa.int64())], names=["id", "add"])

    rows = tasks.select(F.col(scope).alias("s"), F.col(order).alias("o"), F.col("id").cast("long").alias("id"), F.col(density).cast("double").alias("v"))
    return rows.repartition("s").sortWithinPartitions("s", "o", "id", "v").select("s", "id", "v").mapInArrow(run, "id long, add long")
