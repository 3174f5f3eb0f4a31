"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local master, whose executor is this machine, gets a
    folder of its own where the setting is missing; a cluster without it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        sc = spark.sparkContext
        named = sc.getCheckpointDir()
        if not named:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="marlstone-")
            sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed at the end of the application if nothing removed it before."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    jpath, fs = _file_system(spark, path)
    fs.deleteOnExit(jpath)
    return path


def remove(spark: SparkSession, path: str) -> None:
    jpath, fs = _file_system(spark, path)
    fs.delete(jpath, True)
    fs.cancelDeleteOnExit(jpath)


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stash(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read back: its lineage ends at files that outlive any executor.

    The shuffle files of the write go as soon as it is done; nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def drop_stash(*frames: DataFrame) -> None:
    """Removes the files of stashes that no later plan reads."""
    for df in frames:
        remove(df.sparkSession, df._stash_path)


def _width(col, kind: T.DataType):
    """Bytes that a value takes as a row in memory, as a column."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return F.lit(24) + 8 * F.coalesce(F.greatest(F.size(col), F.lit(0)), F.lit(0))
    return F.lit(16)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcasts a written side whose rows come to at most limit bytes, as measured; beyond it the join shuffles."""
    size = sum((_width(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    held = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if held <= limit else df


def unit_hash(key, seed: int):
    """A uniform in [0, 1) from the md5 of seed and key; a null key has one of its own."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def let(value, body):
    """body(value) with value computed once: a lambda would compute a captured expression again for every element."""
    return F.get(F.transform(F.array(value), body), 0)
