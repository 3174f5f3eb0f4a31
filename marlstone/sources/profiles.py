"""Column maps of known dumps (canonical -> source column), workbooks, nested examples and a demonstration corpus."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whoever has a dump of their own adds its map here or passes overrides; "generic" has the canonical names themselves.
PROFILES: dict[str, dict[str, str]] = {
    "tenders": {"number": "tender_id", "title": "tender_name", "price": "start_price", "published": "publish_ts", "phase": "stage", "law": "law", "url": "link", "region": "region_name", "customer": "buyer", "winner": "supplier"},
    "contracts": {"number": "reg_num", "title": "subject", "price": "sum", "published": "sign_date", "law": "fz", "customer": "customer_name", "items": "products"},
    "sheet": {"number": "id", "title": "name", "url": "href", "price": "cost"},
    "generic": {k: k for k in ("number", "title", "price", "published", "phase", "law", "url", "region", "customer", "winner", "items")},
}


def recovered_id(number, url):
    """The number if it has all its 19 digits, else the first run of 19 digits in the address, else the number as it is."""
    found = F.regexp_extract(url, r"([0-9]{19})", 1)
    return F.when(number.rlike(r"^[0-9]{19,}$") | F.coalesce(found == "", F.lit(True)), number).otherwise(found)


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _cells(data: bytes) -> list[list[str | None]]:
    """The values of a workbook's first sheet, by row and column."""
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    sheets = sorted((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
    rows = []
    for row in ElementTree.fromstring(book.read(sheets[0])).iter(f"{{{_NS['m']}}}row"):
        out: dict[int, str | None] = {}
        for c in row.findall("m:c", _NS):
            letters = re.sub(r"[^A-Z]", "", c.get("r", "")) or "A"
            at = 0
            for ch in letters:
                at = 26 * at + ord(ch) - 64
            value = c.findtext("m:v", None, _NS)
            if c.get("t") == "s" and value is not None:
                value = shared[int(value)]
            elif c.get("t") == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            out[at - 1] = value
        rows.append([out.get(i) for i in range(max(out, default=-1) + 1)])
    return rows


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of a workbook, its first row as header, all strings; rows without a value are left out. A sheet has at
    most 1,048,576 rows by its format, and one task reads it."""
    data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    rows = _cells(data)
    header = [h or f"column{i}" for i, h in enumerate(rows[0])] if rows else []
    body = [tuple((r + [None] * len(header))[: len(header)]) for r in rows[1:] if any(v not in (None, "") for v in r)]
    return spark.createDataFrame(body, ", ".join(f"`{h}` string" for h in header)) if header else spark.createDataFrame([], "column0 string")


EXAMPLE = """id string, question string, answer string, answer_aliases array<string>, answerable boolean,
paragraphs array<struct<idx:int,title:string,paragraph_text:string,is_supporting:boolean>>,
question_decomposition array<struct<id:int,question:string,answer:string,paragraph_support_idx:int>>"""


def read_examples(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Multi-hop examples of JSON Lines that can be used: answerable, of two hops or more, each with an answer and a paragraph."""
    rows = spark.read.option("recursiveFileLookup", True).schema(EXAMPLE).json(path)
    places = F.transform("paragraphs", lambda p: p["idx"])
    hop = lambda h: (F.trim(h["answer"]) != "") & F.array_contains(places, h["paragraph_support_idx"])
    kept = rows.where(F.coalesce(F.col("answerable") & (F.size("question_decomposition") >= 2) & F.forall("question_decomposition", hop), F.lit(False)))
    return kept if limit is None else kept.limit(limit)


def demo_corpus(spark: SparkSession) -> DataFrame:
    """54 chunks (file_name, index, raw_text, title): 12 documents of 4 chunks that cite each other, and 2 near copies of 3."""
    rows = []
    for kind, n, branch in (("org", 5, "bodies"), ("project", 4, "works"), ("park", 3, "places")):
        for i in range(n):
            for j, part in enumerate(("Origin", "Duties", "Budget", "Partners")):
                text = f"{part} of {kind.title()} {i:02d}. It was registered as {kind.upper()}-{100 + i} in {1990 + 3 * i}, spends {1000 * (i + j + 1)} a year and works with Org {(i + j) % 5:02d} at Park {(i + 2 * j) % 3:02d}."
                rows.append((f"{kind}_{i:02d}", j, text, f"root/{branch}/{kind}/{part.lower()}"))
    for i in range(2):
        rows += [(f"org_{i:02d}_digest", j, f"{r[2]} Digest {i}.", f"root/bodies/digest/{j}") for j, r in enumerate(r for r in rows if r[0] == f"org_{i:02d}" and r[1] < 3)]
    return spark.createDataFrame(rows, "file_name string, index long, raw_text string, title string")
