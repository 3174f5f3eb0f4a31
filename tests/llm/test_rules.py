"""Line dedup, mixing and quality rules: against their SQL and on edge rows."""

import functools

import duckdb
import pytest

from marlstone.llm import line_dedup, mixing, quality
from marlstone.llm import queries as registered

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(registered.oracle_sql()[name])
    got = registered.queries()[name](spark, SF)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.select(*cols).fetchall())


def test_lines_on_edge_rows(spark):
    rows = [(2, "b\n\na\nb"), (1, "a\n \nc"), (None, "c"), (3, None), (4, ""), (5, "a\nc"), (2, "b\n\na\nb"), (6, "new\n" * 3)]
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, h int, p int, kept int")
    got = {r.doc_id: (r.n_lines, r.n_kept, r.keep_bitmap) for r in line_dedup.line_dedup(docs).collect()}
    assert got == {None: (1, 1, "0,1"), 1: (3, 2, "0,2,1"), 2: (4, 2, "0,2,2"), 3: (0, 0, ""), 4: (1, 1, "0,1"), 5: (2, 0, "2"), 6: (4, 2, "0,1,2,1")}
    flags = line_dedup.line_dedup(docs).select("doc_id", line_dedup.keep_flags(line_dedup.F.col("keep_bitmap")).alias("f")).collect()
    assert {r.doc_id: r.f for r in flags}[6] == [True, False, False, True]
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_mixing_on_edge_rows(spark):
    rows = [(1, "a", 10), (1, "a", 10), (2, "a", None), (None, None, 5), (3, "z", -4), (4, "b", 1000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, n_chars long, s int, epochs int")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 6 and all(r.copies >= 0 for r in got)
    by = {(r.doc_id, r.source): r for r in got}
    assert by[3, "z"].epochs == 0 and by[None, None].epochs == 3.0 and by[1, "a"].epochs == 3.0
    assert by[4, "b"].epochs == pytest.approx((1025 - 75) / 1000, abs=1e-9)
    assert mixing.mix_sources(docs, weights={"a": 1.0, "b": 0.0}).where("source = 'b' AND copies > 0").count() == 0
    again = mixing.mix_sources(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_no_source_passes_its_cap(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = {r.source: r.z for r in docs.groupBy("source").agg({"n_chars": "sum"}).withColumnRenamed("sum(n_chars)", "z").collect()}
    for ratio, cap in ((1.0, 3.0), (2.5, 3.0), (9.0, 3.0), (0.2, 1.0)):
        e = {r.s: r.epochs for r in mixing.source_epochs(docs, None, cap, ratio).collect()}
        assert all(0 <= x <= cap + 1e-9 for x in e.values())
        assert sum(e[s] * z for s, z in size.items()) == pytest.approx(min(ratio, cap) * sum(size.values()), rel=1e-6)


def test_rules_on_edge_rows(spark):
    rows = [(1, None), (2, " \n\t"), (3, "word"), (4, "!!! $$$"), (5, "A B C"), (None, "fine words here"), (6, "x" * 90000), (7, "plain text " * 9000), (3, "word")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    got = sorted(((r.doc_id or -1), r.keep) for r in quality.quality_rules(docs).collect())
    assert got == [(-1, True), (1, False), (2, False), (3, True), (3, True), (4, False), (5, True), (6, False), (7, False)]
    assert quality.keep_quality(docs).columns == docs.columns
    assert quality.quality_rules(docs.limit(0)).count() == 0


def test_order_of_rules_never_changes_the_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = list(quality.NAMES)
    a, b, c = (docs.where(quality.verdict(quality.F.col("text"), order).isNull()).select("doc_id") for order in (names, names[::-1], names[3:] + names[:3]))
    alone = docs.where(~functools.reduce(lambda x, y: x | y, [quality.F.coalesce(r, quality.F.lit(False)) for r in quality.rules(quality.F.col("text")).values()])).select("doc_id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) == sorted(map(tuple, c.collect())) == sorted(map(tuple, alone.collect()))
    assert sorted(n for n, _, _ in quality.measure(docs)) == sorted(names)


def test_cascade_counts_what_earlier_rules_let_pass():
    """b rejects most but only what a rejects too, at a lower cost; c, which rejects others, comes before it."""
    held = [({"a", "b"}, 50), ({"c"}, 10), (set(), 40)]
    got = quality.cascade(held, {"a": 1.0, "b": 1.1, "c": 1.0})
    assert got == [("a", 1.0, 0.5), ("c", 1.0, 0.2), ("b", 1.1, 0.0)]


def test_clean_texts_of_any_length_and_script_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1"), "doc_id").where("lang = 'en'")
    words = " ".join(r.text for r in docs.select("text").collect()).split()
    rows = [(i, " ".join(words[:n])) for i, n in enumerate((5000, 50_000, 100_000, 200_000))]
    rows += [(10, "我们在城里买了很多新鲜的水果然后回家做饭，" * 3 + "明天再去河边散步看看老朋友。" * 5), (11, "# Heading of the page\nThe market opens early & closes late, and a bag of fruit costs $3.50 or so.\n| item | price |\n|---|---|\n| apples and pears from the market | $3.50 |\n* first point of the list, 20% off for whoever comes before noon on a weekday\n* second point, without any reduction but with a bag of plums on top of it, which nobody has to take home"), (12, "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย" * 4)]
    bad = [(20, "w" * 70_000), (21, "same words again " * 30_000), (22, "#$%& *|! x" * 5000)]
    frame = spark.createDataFrame(rows + bad, "doc_id long, text string")
    got = {r.doc_id: r.keep for r in quality.quality_rules(frame).collect()}
    assert {d for d, k in got.items() if k} == {d for d, _ in rows}


def test_sample_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_FILES", 3)
    frame = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    frame.repartition(12).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    drawn = quality.draw(many, 100)
    assert drawn.rdd.getNumPartitions() == 1 and 40 <= drawn.count() <= 250
    assert 40 <= quality.draw(many.where("doc_id >= 0").distinct(), 100).count() <= 250


def test_labels_of_quality(spark):
    """Clean documents stay, junk goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.quality_rules(docs).join(labels, "doc_id").groupBy("quality").agg({"keep": "count"}).collect()
    kept = {r.quality: r.n for r in quality.quality_rules(docs).where("keep").join(labels, "doc_id").groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    total = {r.quality: r[1] for r in got}
    assert kept[1] >= 0.998 * total[1] and kept.get(0, 0) <= 0.01 * total[0]
