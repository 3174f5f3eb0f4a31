"""Sources: chunk files, sidecars, delimited dumps by profile, archives of XML records."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORE = "file_name string, index long, raw_text string, document_id string, title string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON Lines file or folder; a missing path is an empty table."""
    return spark.read.schema(schema).json(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of .jsonl files, and of other files that hold an array, an object or lines of JSON, told by how they begin; a folder
    is read recursively.

    Every key that isn't a core field goes into meta; rows without file_name, index or text are skipped, and so are lines that
    are no JSON. Of rows with one chunk_id the first by file and position in it stays.
    """
    where = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    files = spark.read.option("recursiveFileLookup", True)
    whole = F.lit(False) if path.endswith(".jsonl") else ~F.col("_metadata.file_path").endswith(".jsonl")
    rows = files.text(path).where(~whole).select("value", where.alias("o"), F.lit(0).alias("j"))
    if not path.endswith(".jsonl"):
        # Whole files hold one array or object, or, whatever their name, lines of JSON.
        docs = files.text(path, wholetext=True).where(whole).select(F.trim("value").alias("value"), where.alias("o"))
        parts = F.when(F.startswith("value", F.lit("[")), F.from_json("value", "array<string>")).when(F.from_json("value", CORE)["file_name"].isNotNull() & ~F.col("value").rlike(r"\}\s*\n\s*\{"), F.array("value")).otherwise(F.split("value", "\n"))
        rows = rows.unionByName(docs.select(F.posexplode(parts).alias("j", "value"), "o").select("value", "o", "j"))
    kept = rows.select("value", F.from_json("value", CORE).alias("c"), F.from_json("value", "map<string,string>").alias("m"), F.struct("o", "j").alias("o"))
    kept = kept.where("c.file_name IS NOT NULL AND c.index IS NOT NULL AND c.raw_text IS NOT NULL")
    names = [x.split()[0] for x in CORE.split(", ")]
    out = kept.select(
        F.concat_ws("::", "c.file_name", "c.index").alias("chunk_id"),
        "c.file_name",
        "c.index",
        "c.raw_text",
        F.coalesce("c.document_id", F.lit("")).alias("document_id"),
        F.coalesce("c.title", F.lit("")).alias("title"),
        F.map_filter("m", lambda k, v: ~k.isin(names) & v.isNotNull()).alias("meta"),
        "o",
    )
    return out.withColumn("rn", F.row_number().over(Window.partitionBy("chunk_id").orderBy("o"))).where("rn = 1").drop("rn", "o")


def with_sidecar(chunks: DataFrame, sidecar: DataFrame) -> DataFrame:
    """chunks with the entries of sidecar (chunk_id, meta) laid over their own; the last of several rows wins, by its column
    ord if there is one, else in the order in which its files and rows are read."""
    last = sidecar.withColumn("o", F.col("ord") if "ord" in sidecar.columns else F.monotonically_increasing_id()).groupBy("chunk_id").agg(F.max_by("meta", "o").alias("over"))
    joined = chunks.join(last, "chunk_id", "left")
    own = F.map_filter("meta", lambda k, v: F.col("over").isNull() | ~F.map_contains_key("over", k))
    return joined.withColumn("meta", F.when(F.col("over").isNull(), F.col("meta")).otherwise(F.map_concat(own, "over"))).drop("over")


def detect_profile(header: list[str], profiles: dict[str, dict[str, str]]) -> str | None:
    """The first profile (canonical -> source column) of which at least 3 columns and half of them, rounded down, are in the header."""
    seen = {h.strip() for h in header}
    for name, mapping in profiles.items():
        if len(seen & set(mapping.values())) >= max(3, len(mapping) // 2):
            return name
    return None


def parse_overrides(pairs: list[str], canonical: set[str]) -> dict[str, str]:
    """["canonical=column"] as a mapping; unknown names and malformed pairs are errors."""
    out = {}
    for pair in pairs:
        name, sep, column = pair.partition("=")
        if not sep or not column or name not in canonical:
            raise ValueError(f"not canonical=column: {pair}")
        out[name] = column
    return out


def read_table(spark: SparkSession, path: str, mapping: dict[str, str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The mapped columns of a delimited file under their canonical names, all strings; rows with no value are dropped."""
    raw = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)
    cols = [F.trim(F.col(f"`{c}`")).alias(k) for k, c in mapping.items() if c in raw.columns]
    rows = raw.select(*cols)
    return rows.where(F.length(F.concat_ws("", *rows.columns)) > 0)


def unpack(data: bytes, name: str, depth: int = 3) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of the XML files in data; archives in archives to the given depth; what can't be read is skipped."""
    if name.lower().endswith(".zip"):
        if depth <= 0:
            return
        try:
            archive = zipfile.ZipFile(io.BytesIO(data))
            members = sorted(archive.namelist())
        except zipfile.BadZipFile:
            return
        for inner in members:
            try:
                held = archive.read(inner)
            except (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, RuntimeError, NotImplementedError):
                continue
            yield from unpack(held, f"{name}!{inner}", depth - 1)
    elif name.lower().endswith(".xml"):
        yield name, data


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def parse_record(data: bytes, ids: tuple[str, ...] = ("purchaseNumber", "regNum", "id"), titles: tuple[str, ...] = ("purchaseObjectInfo", "name"), skip: tuple[str, ...] = ("signature", "cryptoSigns")) -> dict | None:
    """{kind, id, title, sections: [(title, lines)]} of an XML record, or None if it has no leaf. Wrappers of a single
    element are opened; branches become sections, repeated siblings are numbered, signature branches are left out."""
    try:
        node = ElementTree.fromstring(data)
    except ElementTree.ParseError:
        return None
    while len(node) == 1 and len(node[0]):
        node = node[0]

    def label(tag: str) -> str:
        out = "".join(" " + c.lower() if c.isupper() and i and not tag[i - 1].isupper() else c for i, c in enumerate(_local(tag)))
        return out[:1].upper() + out[1:]

    def leaves(e) -> list[str]:
        out = []
        for c in e:
            if _local(c.tag) in skip:
                continue
            out += leaves(c) if len(c) else [f"{label(c.tag)}: {' '.join(c.text.split())}"] if (c.text or "").strip() else []
        return out

    flat = {_local(c.tag): " ".join((c.text or "").split()) for c in node.iter() if not len(c) and (c.text or "").strip()}
    if not flat:
        return None
    own = [f"{label(c.tag)}: {' '.join(c.text.split())}" for c in node if not len(c) and (c.text or "").strip()]
    sections = [(label(node.tag), own)] if own else []
    branches = [c for c in node if len(c) and _local(c.tag) not in skip]
    counts: dict[str, int] = {}
    for c in branches:
        counts[c.tag] = counts.get(c.tag, 0) + 1
    at: dict[str, int] = {}
    for c in branches:
        at[c.tag] = at.get(c.tag, 0) + 1
        if lines := leaves(c):
            sections.append((label(c.tag) + (f" {at[c.tag]}" if counts[c.tag] > 1 else ""), lines))
    return {"kind": _local(node.tag), "id": next((flat[i] for i in ids if i in flat), ""), "title": next((flat[t] for t in titles if t in flat), ""), "sections": sections}


RECORD = "name string, kind string, id string, title string, sections array<struct<title:string,lines:array<string>>>"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the XML files and archives under a folder, each task unpacking its own files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"]):
                for inner, data in unpack(content, name.rsplit("/", 1)[-1]):
                    if (r := parse_record(data)) is not None:
                        rows.append((inner, r["kind"], r["id"], r["title"], [{"title": t, "lines": x} for t, x in r["sections"]]))
            yield pd.DataFrame(rows, columns=["name", "kind", "id", "title", "sections"])

    return files.mapInPandas(run, RECORD)
