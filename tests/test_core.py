"""Queries against their SQL, and the exact expectations of single operators."""

import json
import math
import random
import zipfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.operators import chunks as C
from marlstone.operators import dedup as D
from marlstone.operators import dialogue as L
from marlstone.operators import facets as A
from marlstone.operators import mining as M
from marlstone.operators import retrieval as R
from marlstone.operators import sequential as X
from marlstone.plans import registry
from marlstone.sources import readers, sinks
from marlstone.streaming import windows

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_stems(spark):
    words = ["walking", "walk", "walked", "bus", "12345", "reason"]
    got = [one(spark, T.stem(F.lit(w))) for w in words]
    assert got == ["walk", "walk", "walk", "bus", "12345", "reas"]


def test_paths(spark):
    assert one(spark, T.path_scope(F.lit("a/b/c/d"), 1, 2)) == "a/b"
    assert one(spark, T.path_scope(F.lit("a/b/c"), 0, 2)) == "a/b"
    assert one(spark, T.path_scope(F.lit("a/b/c"), 1, 2)) == ""
    assert one(spark, T.path_segments(F.lit(" a / /b "))) == ["a", "b"]


def test_texts(spark):
    assert one(spark, T.money(F.lit(571883910.0))) == "571 883 910,00"
    assert [one(spark, T.clean(F.lit(t))) for t in ("  a \n b ", "N/A", "-", '"x" - y ,z')] == ["a b", "", "", "«x» — y,z"]
    assert one(spark, T.n_words(F.lit("  "))) == 0 and one(spark, T.n_words(F.lit(" a  b "))) == 2
    assert one(spark, T.letter_ratio(F.lit("ab 12"))) == 0.5
    assert one(spark, X.echo_free(F.array(F.lit("Office chairs"), F.lit("chairs"), F.lit("desk")))) == ["Office chairs", "desk"]
    assert one(spark, L.rewrite(F.lit("When did #1 leave #2?"), F.array(F.lit("Who is it"), F.lit("Where is it")))) == "When did that person leave that place?"


def test_minhash_of_nothing(spark):
    assert one(spark, T.minhash(F.array().cast("array<string>"))) == [0] * 64


def test_windows_stay_within_a_file(spark):
    text = " ".join(["word"] * 60)
    data = [("a", i, f"a::{i}", text) for i in range(4)] + [("b", i, f"b::{i}", text) for i in (0, 2)]
    got = C.neighbour_windows(spark.createDataFrame(data, "file_name string, idx long, chunk_id string, raw_text string"))
    found = [tuple(map(int, r.indices.split(", "))) for r in got.collect()]
    assert {r.file_name for r in got.collect()} == {"a"} and all(list(f) == list(range(f[0], f[-1] + 1)) for f in found)


def test_a_chunk_beyond_the_cap_is_a_unit_of_its_own(spark):
    data = [("a", i, "x" * n) for i, n in enumerate((10, 90, 20, 30, 30))]
    got = C.packed_units(spark.createDataFrame(data, "file_name string, idx long, raw_text string"), 60, 8)
    assert sorted((r.first, r.last) for r in got.collect()) == [(0, 0), (1, 1), (2, 3), (4, 4)]


def angles(spark, *degrees):
    return spark.createDataFrame([(i, [math.cos(math.radians(a)), math.sin(math.radians(a))]) for i, a in enumerate(degrees)], "id long, vec array<float>")


def test_dense_neighbours_at_known_angles(spark):
    v = angles(spark, 0, 5, 10, 15, 60)
    for block in (1, 2, 64):
        got = {(r.query_id, r["rank"]): r.id for r in R.dense_topk(v, v, 2, block=block).collect()}
        assert got[0, 1] == 1 and got[0, 2] == 2 and got[4, 1] == 3


def test_gaps(spark):
    assert one(spark, R.gap(F.lit(0.0), F.lit(0.0))) == 1.0 and one(spark, R.gap(F.lit(0.5), F.lit(1.0))) == 0.5
    assert [one(spark, R.gap_bin(F.lit(x))) for x in (0.33, 0.5, 0.67)] == ["low", "mid", "high"]


def greedy(texts, least=0.8):
    from hashlib import md5
    import re

    kept = []
    for i, t in texts:
        ws = re.findall(r"[^\W_]+", t.lower())
        grams = {" ".join(ws[k : k + 4]) for k in range(len(ws) - 3)} if len(ws) >= 4 else {" ".join(ws)}
        sig = [min(int(md5(f"{p}:{g}".encode()).hexdigest()[:8], 16) for g in grams) for p in range(64)]
        if all(sum(a == b for a, b in zip(sig, s)) < least * 64 for _, s in kept):
            kept.append((i, sig))
    return [i for i, _ in kept]


def test_greedy_near_copies(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").where("role = 'user'")
    texts = sorted((r.conv_id * 1000 + r.turn, r.text) for r in turns.collect())
    got = sorted(r.id for r in registry.queries()["minhash_dedup_greedy"](spark, SF).collect())
    assert got == greedy(texts)


def test_keep_first_is_no_component(spark):
    """1 ~ 2 ~ 3 without 1 ~ 3: 3 stays, since 2 is gone."""
    ids, edges = spark.range(1, 6).toDF("id"), spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")
    got = L.with_checkpoints(spark, lambda: D.keep_first(ids, edges))
    assert sorted(r.id for r in got.collect()) == [1, 3, 5]


@pytest.mark.parametrize("limit", [100_000, 40])
def test_keep_first_equals_the_plain_loop(spark, limit):
    """A chain of 300 ids, beside random edges that rounds settle first."""
    rng = random.Random(3)
    loose = [tuple(sorted(rng.sample(range(1000, 1060), 2))) for _ in range(90)]
    links = [(i, i + 1) for i in range(300 if limit > 1000 else 30)] + loose
    n, near, want = 1060, {}, []
    for a, b in links:
        near.setdefault(b, set()).add(a)
    for i in range(n):
        if not near.get(i, set()) & set(want):
            want.append(i)
    ids, edges = spark.range(n), spark.createDataFrame(links, "a long, b long")
    got = L.with_checkpoints(spark, lambda: D.keep_first(ids, edges, limit))
    assert sorted(r.id for r in got.collect()) == want


CARDS = [("1", "North", 2021, "10.5", "2021-03-04"), ("2", "north ", 2022, "200", "2022-12-30"), ("3", None, 2022, "", "2022-01-02"), ("4", "South", 2023, "x", None)]
KINDS = {"number": "cat", "region": "cat", "year": "num", "price": "num_text", "published": "date"}


@pytest.mark.parametrize(
    ("constraints", "want"),
    [
        ([("region", "eq", "NORTH")], "12"),
        ([("region", "neq", "north")], "4"),
        ([("region", "prefix", "so")], "4"),
        ([("price", "gte", 10)], "12"),
        ([("price", "neq", 10.5)], "2"),
        ([("published", "month_not_in", [12])], "13"),
        ([("published", "prefix", "2022")], "23"),
        ([("year", "between", [2022, 2023]), ("region", "not_in", ["North"])], "4"),
    ],
)
def test_filters(spark, constraints, want):
    cards = spark.createDataFrame(CARDS, "number string, region string, year int, price string, published string")
    condition = A.compile_filter([dict(zip(("field", "op", "value"), c)) for c in constraints], KINDS)
    assert "".join(sorted(r.number for r in cards.where(condition).collect())) == want


@pytest.mark.parametrize("bad", [("nope", "eq", 1), ("region", "lt", 1), ("year", "in", 3), ("year", "between", [1])])
def test_bad_filters(spark, bad):
    with pytest.raises(ValueError, match="."):
        A.constraint(*bad, KINDS)


def test_a_pushed_down_filter(spark):
    plan = registry.queries()["facet_filter_number"](spark, SF)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_totalprice,50000.0)" in plan.rpartition("Physical Plan")[2]


def test_repairs(spark):
    data = spark.createDataFrame([(str(i), i % 2, i % 3, i) for i in range(30)], "number string, a int, b int, c int")
    run = lambda gold, base, *extra, **how: X.repair_filter(data, data.where(gold), F.expr(base), [F.expr(e) for e in extra], **how)
    assert run("a = 1", "a = 1") == ("exact", [])
    assert run("a = 1", "a = 0") == ("gold_violation", [])
    assert run("a = 1 AND b = 2", "a = 1", "c < 3", "b = 2") == ("repaired", [1])
    assert run("a = 1 AND c < 9", "a = 1", "c >= 0") == ("no_progress", [])
    assert run("a = 1 AND c < 25", "a = 1", "c >= 0") == ("augmented", [])
    assert run("a = 1 AND b = 2 AND c < 9", "true", "a = 1", "b = 2", "c < 9", rounds=1) == ("limit", [2])


def test_datamix(spark):
    got = registry.queries()["one_of_n_datamix"](spark, SF)
    cands = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = len(r.text)
        cands.setdefault(r.doc_id // 3, []).append((float(n), r.doc_id, 0 if n <= 800 else 1 if n <= 2400 else 2))
    tally, want = [0, 0, 0], []
    for b in sorted(cands):
        best = max(cands[b], key=lambda c: (round((0.3, 0.4, 0.3)[c[2]] - (tally[c[2]] / sum(tally) if sum(tally) else 0.0), 6), c[0], c[1]))
        tally[best[2]] += 1
        want.append((b, best[1], X.BINS[best[2]]))
    assert sorted((r.batch, r.id, r.bin) for r in got.collect()) == want


def test_disjoint_first(spark):
    pairs = spark.createDataFrame([("g", a, b) for a, b in ((1, 2), (1, 3), (3, 4), (2, 4))], "grp string, a long, b long")
    got = X.disjoint_pairs(pairs, "grp", ["a", "b"], 3).orderBy("place").collect()
    assert [(r.a, r.b, r.place) for r in got] == [(1, 2, 1), (3, 4, 2), (1, 3, 3)]


def test_leave_one_out():
    assert len(X.leave_one_out([1, 2, 3, 4], lambda rest: True)) == 2
    assert X.leave_one_out([1, 2, 3, 4], lambda rest: False) == [1, 2, 3, 4]
    assert X.leave_one_out([1, 2, 3], lambda rest: {1, 3} <= set(rest)) == [1, 3]


def test_json_in_prose(spark):
    texts = ['{"a": 1}', 'so: ```json\n{"a": {"b": "}"}}\n```', "none { at all", 'x {bad} {"ok": true}', None]
    want = [{"a": 1}, {"a": {"b": "}"}}, None, {"ok": True}, None]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.extract_json(F.col("t")).alias("j")).orderBy("i").collect()
    assert [r.j and json.loads(r.j) for r in got] == want


def test_sections():
    short, long = ("A", ["x" * 30]), ("B", ["y" * 50] * 10)
    assert X.pack_sections([short, short, short], 200, 100, 10)[0].startswith("A\n")
    cut = X.cut_section(*long, 200)
    assert all(len(t) <= 200 for t in cut) and cut[1].startswith("B (part 2)\n") and sum(t.count("y" * 50) for t in cut) == 10
    assert X.pack_sections([("A", ["a" * 40]), ("B", ["b" * 40])], 1400, 600, 10, 40, 2) == ["A\n" + "a" * 40, "B\n" + "b" * 40]
    assert X.pack_sections([], 100) == []


def test_section_query(spark):
    got = registry.queries()["section_chunker"](spark, SF).collect()
    assert got and all(len(r.raw_text) <= 320 for r in got) and any(r["index"] > 1 for r in got)


def test_holdout_leaks_nothing(spark):
    tasks = spark.createDataFrame([(1, "holdout", ["a", "b"]), (2, "train", ["b"]), (3, "train", ["c"])], "id long, split string, gold array<string>")
    assert sorted(r.id for r in X.split_gold(tasks).collect()) == [1, 3]


def test_merge(spark):
    parts = spark.createDataFrame([("k", "Road", "", "left", 1), ("k", "Road works, city", "5", "right", 2), ("k", "Other", "7", "right", 3)], "number string, t string, p string, origin string, o int")
    r = A.merge_records(parts, "number", ["t", "p"], "o").first()
    assert (r.t, r.p, r.origins) == ("Road works, city", "5", "left,right")


def test_percentile_is_half_even(spark):
    v = spark.createDataFrame([(float(i),) for i in range(1, 7)], "x double")
    assert M.nearest_rank(v, "x", 0.5).first().threshold == 3.0


def test_readers_and_sinks(spark, tmp_path):
    lines = [{"file_name": "a", "index": 0, "raw_text": "x", "region": "N"}, {"file_name": "a", "index": 1}, {"file_name": "a", "index": 0, "raw_text": "late"}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/x.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    got = readers.read_chunks(spark, str(tmp_path / "c")).collect()
    assert [(r.chunk_id, r.raw_text, r.meta) for r in got] == [("a::0", "x", {"region": "N"})]
    (tmp_path / "y.json").write_text(json.dumps(lines[:1]))
    assert readers.read_chunks(spark, str(tmp_path / "y.json")).count() == 1
    side = spark.createDataFrame([("a::0", {"region": "S", "k": "v"})], "chunk_id string, meta map<string,string>")
    assert readers.with_sidecar(readers.read_chunks(spark, str(tmp_path / "c")), side).first().meta == {"region": "S", "k": "v"}
    assert readers.read_jsonl(spark, str(tmp_path / "missing.jsonl"), "a int").count() == 0
    sinks.write_jsonl(spark.range(3).toDF("id"), str(tmp_path / "done"))
    left = sinks.not_done(spark.range(5).toDF("id"), readers.read_jsonl(spark, str(tmp_path / "done"), "id long"), "id")
    assert sorted(r.id for r in left.collect()) == [3, 4]
    a = spark.createDataFrame([("g", 10, 5)], "gate string, seen long, passed long")
    assert tuple(sinks.add_counters(a, a).first()) == ("g", 20, 10, 0.5)


def test_dump_profiles(spark, tmp_path):
    profiles = {"one": {"number": "id", "name": "title", "price": "sum", "x": "y"}, "two": {"number": "No", "name": "Name", "price": "Price"}}
    assert readers.detect_profile(["No", "Name", "Price", "?"], profiles) == "two" and readers.detect_profile(["No"], profiles) is None
    assert readers.parse_overrides(["price=Cost"], {"price"}) == {"price": "Cost"}
    with pytest.raises(ValueError, match="canonical"):
        readers.parse_overrides(["nope=Cost"], {"price"})
    (tmp_path / "d.csv").write_text('No;Name;Price\n1;"a; b";5\n;;\n')
    got = readers.read_table(spark, str(tmp_path / "d.csv"), profiles["two"], ";").collect()
    assert [tuple(r) for r in got] == [("1", "a; b", "5")]


XML = b"""<e:export xmlns:e="urn:e"><notice><id>7</id><purchaseNumber>0123</purchaseNumber><name>Road works</name>
<item><title>sand</title><sum>5</sum></item><item><title>lime</title></item><signature><x>zz</x></signature></notice></e:export>"""


def test_records(spark, tmp_path):
    r = readers.parse_record(XML)
    assert (r["kind"], r["id"], r["title"]) == ("notice", "0123", "Road works")
    assert [t for t, _ in r["sections"]] == ["Notice", "Item 1", "Item 2"] and "zz" not in str(r)
    assert readers.parse_record(b"<broken") is None and readers.parse_record(b"<a/>") is None
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        z.writestr("a.xml", XML)
        z.writestr("b.txt", "no")
    with zipfile.ZipFile(tmp_path / "out.zip", "w") as z:
        z.write(tmp_path / "in.zip", "in.zip")
    (tmp_path / "in.zip").unlink()
    (tmp_path / "bad.zip").write_bytes(b"PK nothing")
    got = readers.read_records(spark, str(tmp_path)).collect()
    assert [(r.name, r.id) for r in got] == [("out.zip!in.zip!a.xml", "0123")]


def test_injection(spark):
    chunks = spark.createDataFrame([("a", 0, "one"), ("a", 3, "two")], "file_name string, index long, raw_text string")
    new = spark.createDataFrame([("a", "three", 1), ("a", " ONE ", 2), ("b", "four", 1)], "file_name string, raw_text string, ord int")
    assert sorted(r.chunk_id for r in sinks.inject(chunks, new).collect()) == ["a::4", "b::0"]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.coalesce(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "e"))
    stream = windows.windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = windows.windowed_counts(events).collect()
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, want))


def test_unit_hash_is_uniform(spark):
    xs = np.array([r.x for r in spark.range(4000).select(T.unit(F.col("id"), "t").alias("x")).collect()])
    assert xs.min() >= 0 and xs.max() < 1 and abs(xs.mean() - 0.5) < 0.02


def test_random_pairs_of_shingles(spark):
    rng = random.Random(4)
    data = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))) for i in range(30)]
    got = {(r.a, r.b): r.jaccard for r in D.shingle_pairs(spark.createDataFrame(data, "id long, text string"), 3).collect()}
    grams = {}
    for i, t in data:
        w = t.split()
        grams[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}
    want = {(a, b): round(len(grams[a] & grams[b]) / len(grams[a] | grams[b]), 6) for a in grams for b in grams if a < b and grams[a] & grams[b]}
    assert got == pytest.approx(want)
