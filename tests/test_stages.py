"""Stage control, sources beyond plain files, and sequential operators against plain loops."""

import io
import json
import math
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.functions import records as G
from marlstone.operators import dedup as D
from marlstone.operators import facets as A
from marlstone.operators import mining as M
from marlstone.operators import retrieval as R
from marlstone.operators import sequential as X
from marlstone.operators import stages as ST
from marlstone.sources import profiles, readers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_a_log_decides_once(spark):
    todo = spark.createDataFrame([(1, True), (2, False), (3, True), (4, None)], "k long, ok boolean")
    log = spark.createDataFrame([(1, "leak"), (2, "pass")], "k long, outcome string")
    new = ST.decide(todo, log, "k", F.col("ok"), F.lit("broad"))
    assert sorted(map(tuple, new.collect())) == [(3, "pass"), (4, "broad")]
    assert sorted(r.k for r in ST.survivors(todo, log.unionByName(new), "k").collect()) == [2, 3]


def chunks(spark, texts):
    return spark.createDataFrame([("f", i, t, f"f::{i}") for i, t in enumerate(texts)], "file_name string, index long, raw_text string, chunk_id string")


def test_an_index_is_kept_by_signature(spark, tmp_path):
    one_, other = chunks(spark, ["a", "b"]), chunks(spark, ["a", "c"])
    signs = {ST.signature(one_, model="m"), ST.signature(other, model="m"), ST.signature(one_, model="n")}
    assert len(signs) == 3 and ST.signature(one_, model="m") in signs
    built = []

    def build():
        built.append(1)
        return one_

    for _ in range(2):
        assert ST.load_or_build(spark, str(tmp_path / "index"), "s1", build).count() == 2
    assert len(built) == 1


def test_the_last_stage_is_final(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("isolated", "gated")]
    with pytest.raises(FileNotFoundError):
        ST.finalise(spark, paths)
    spark.createDataFrame([(1,)], "id long").write.json(paths[1])
    assert ST.finalise(spark, paths).count() == 1
    spark.createDataFrame([], "id long").write.json(paths[0])
    with pytest.raises(ValueError):
        ST.finalise(spark, paths)


def test_a_corpus_with_sidecars(spark, tmp_path):
    made = ST.write_corpus(chunks(spark, ["One.", "two"]), str(tmp_path))
    assert made["chunks"] == 2 and made["documents"] == 1 and made["chars"] == 7 and made["low_starts"] == 1
    assert json.loads(spark.read.text(f"{tmp_path}/manifest").first().value) == json.loads(json.dumps(made))
    assert spark.read.json(f"{tmp_path}/documents").first().n_chunks == 2


def test_retries():
    said = iter(["no", '{"a": 1}'])
    assert ST.with_retries(lambda p: next(said), wait=0)("x") == {"a": 1}
    assert ST.with_retries(lambda p: "never", wait=0)("x") is None

    def down(prompt):
        raise ConnectionError

    assert ST.with_retries(down, wait=0)("x") is None


def test_a_judge_leaves_rows_undecided(spark):
    def connect():
        def call(prompt):
            if prompt == "down":
                raise ConnectionError
            return f'so: {{"ok": {"true" if prompt == "yes" else "false"}}}'

        return call

    rows = spark.createDataFrame([("yes",), ("no",), ("down",), (None,)], "q string")
    got = {r.q: r.verdict for r in ST.judged(rows, F.col("q"), connect, wait=0).collect()}
    assert got == {"yes": '{"ok": true}', "no": '{"ok": false}', "down": None, None: None}


def test_densification_equals_a_loop(spark):
    rng = random.Random(2)
    rows = [(i, i % 3, float(rng.randrange(0, 40))) for i in range(60)]
    got = {r.id: r["add"] for r in ST.densify(spark.createDataFrame(rows, "id long, s long, v double"), "s", "id", "v", 30.0, 15).collect()}
    want, total = {}, {}
    for i, s, v in rows:
        want[i] = int(min(max(0, 30 - v - total.get(s, 0)), 15))
        total[s] = total.get(s, 0) + want[i]
    assert got == want


def test_minimised_facts_equal_the_loop(spark):
    tasks = spark.createDataFrame([(1, [(1, 5.0), (2, 1.0), (3, 4.0)]), (2, [(1, 1.0), (2, 1.0)]), (3, [])], "task long, xs array<struct<fact:long,w:double>>")
    assert {r.task: r.facts for r in X.minimise(tasks, 0.6).collect()} == {1: "1,3", 2: "1,2", 3: ""}


def test_disjoint_pairs_equal_a_loop(spark):
    rng = random.Random(4)
    rows = sorted({(g, *sorted(rng.sample(range(8), 2))) for g in range(12) for _ in range(10)})
    got = {}
    for r in X.disjoint_pairs(spark.createDataFrame(rows, "g long, a long, b long"), "g", ["a", "b"], 4).orderBy("place").collect():
        got.setdefault(r.g, []).append((r.a, r.b))
    for g in range(12):
        used, first, rest = set(), [], []
        for _, a, b in [r for r in rows if r[0] == g]:
            if a in used or b in used:
                rest.append((a, b))
            else:
                first.append((a, b))
                used |= {a, b}
        assert got[g] == (first + rest)[:4]


def test_spans_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["ab", "abc", "Ab", "x", "x-y", "12", "é"]
    texts = [(f"c{i}", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 14)))) for i in range(60)] + [("n", None)]
    spans = []
    for i in range(80):
        t = rng.choice(texts[:-1])[1]
        a = rng.randrange(0, len(t) + 1)
        spans.append((i, t[a : a + rng.randrange(1, 18)] if i % 4 else rng.choice(words)))
    got = R.containing(spark.createDataFrame(texts, "chunk_id string, whole string"), spark.createDataFrame(spans, "query_id long, span string")).collect()
    want = sorted((i, c) for i, s in spans if s for c, t in texts if t and s in t)
    assert sorted(map(tuple, got)) == want and len(want) > 50


def test_queries_in_blocks(spark):
    rng = random.Random(8)
    rows = [(f"c{i}", " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(0, 9)))) for i in range(200)] + [("n", None)]
    asked = spark.createDataFrame([(i, " ".join(rng.choice("abcdefghz") * 2 for _ in range(3))) for i in range(40)], "query_id long, text string")
    docs = spark.createDataFrame(rows, "chunk_id string, raw_text string")
    whole = sorted(map(tuple, R.bm25(docs, asked, 5).collect()))
    assert whole == sorted(map(tuple, R.bm25(docs, asked, 5, index=R.lexical_index(docs, rows=7), block=3).collect())) and whole
    assert R.bm25(docs.limit(0), asked).count() == 0 and R.bm25(docs, asked.limit(0)).count() == 0


def test_filters_compare_normalised_text(spark):
    rows = spark.createDataFrame([("«North  Shore» ", "1 234,5"), ("south", "x"), (None, None)], "region string, price string")
    kinds = {"region": "cat", "price": "num_text"}
    hit = lambda *c: rows.where(A.compile_filter([dict(zip(("field", "op", "value"), c))], kinds)).count()
    assert hit("region", "eq", '"north shore"') == 1 and hit("region", "prefix", "North") == 1
    assert hit("price", "gt", 1000) == 1 and hit("price", "neq", 5) == 1
    with pytest.raises(ValueError):
        A.constraint("region", "in", [], kinds)


def test_text_of_records(spark):
    assert one(spark, G.smart_case(F.lit("MINISTRY OF FOREST RTF XII"))) == "Ministry of Forest RTF XII"
    assert one(spark, G.smart_case(F.lit("As Written"))) == "As Written"
    assert [one(spark, G.percent(F.lit(t))) for t in ("30.00%", "2.50 %", "x")] == ["30 %", "2,5 %", "x"]
    assert [one(spark, G.number(F.lit(t))) for t in ("1 234,5", "-3", "12a", "")] == [1234.5, -3.0, None, None]
    assert [one(spark, G.iso_date(F.lit(t))) for t in ("2024-03-05T10:00", "05.03.2024", "31.02.2024", "March")] == ["2024-03-05", "2024-03-05", None, None]
    assert one(spark, G.values(F.lit("a|| b ;  c||"))) == ["a", "b", "c"]
    assert one(spark, G.breadcrumb(F.lit("a/bb/ccc"), 7)) == "… > ccc" or one(spark, G.breadcrumb(F.lit("a/bb/ccc"), 100)) == "a > bb > ccc"
    with pytest.raises(ValueError):
        G.scope("other", F.lit("x"))


def workbook(rows):
    cell = lambda r, c, v: f'<c r="{"ABCD"[c]}{r}" t="s"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{"ABCD"[c]}{r}"><v>{v}</v></c>'
    names, body = [], ""
    for i, row in enumerate(rows, 1):
        body += f'<row r="{i}">'
        for c, v in enumerate(row):
            if isinstance(v, str):
                names.append(v)
                body += cell(i, c, len(names) - 1)
            elif v is not None:
                body += cell(i, c, float(v))
        body += "</row>"
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{n}</t></si>" for n in names) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_a_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook([["id", "name", "cost"], ["1", None, 2.5], [None, None, None], ["2", "x", None]]))
    assert [tuple(r) for r in profiles.read_workbook(spark, str(tmp_path / "a.xlsx")).collect()] == [("1", None, "2.5"), ("2", "x", None)]


def test_profiles(spark):
    assert readers.detect_profile(["reg_num", "subject", "sum"], profiles.PROFILES) == "contracts"
    assert readers.detect_profile(["reg_num", "subject"], profiles.PROFILES) is None
    n = "1234567890123456789"
    got = [one(spark, profiles.recovered_id(F.lit(a), F.lit(b))) for a, b in ((n, "x"), ("1.2E18", f"http://h/{n}/y"), ("7", "x"), ("7", None))]
    assert got == [n, n, "7", "7"]


def test_examples_and_demo(spark, tmp_path):
    hop = lambda i, a="x": {"id": i, "question": "q", "answer": a, "paragraph_support_idx": i}
    base = {"question": "q", "answer": "a", "answerable": True, "paragraphs": [{"idx": i, "title": "t", "paragraph_text": "p", "is_supporting": True} for i in range(2)]}
    rows = [base | {"id": "good", "question_decomposition": [hop(0), hop(1)]}, base | {"id": "one", "question_decomposition": [hop(0)]}, base | {"id": "blank", "question_decomposition": [hop(0), hop(1, " ")]}]
    rows += [base | {"id": "lost", "question_decomposition": [hop(0), hop(5)]}, base | {"id": "no", "answerable": False, "question_decomposition": [hop(0), hop(1)]}]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert [r.id for r in profiles.read_examples(spark, str(tmp_path)).collect()] == ["good"]
    demo = profiles.demo_corpus(spark)
    assert demo.count() == 54 and demo.select("file_name").distinct().count() == 14


def test_chunks_of_mixed_folders(spark, tmp_path):
    chunk = lambda f, i, t: {"file_name": f, "index": i, "raw_text": t}
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps(chunk("d", i, f"later {i}")) for i in range(3)) + "\nbroken\n")
    (tmp_path / "a.json").write_text(json.dumps([chunk("d", 0, "first"), chunk("e", 0, "array")]))
    (tmp_path / "c.json").write_text(json.dumps(chunk("g", 0, "object"), indent=1))
    (tmp_path / "d.txt").write_text("\n".join(json.dumps(chunk("h", i, "sniffed")) for i in range(2)))
    got = {r.chunk_id: r.raw_text for r in readers.read_chunks(spark, str(tmp_path)).collect()}
    assert got == {"d::0": "first", "d::1": "later 1", "d::2": "later 2", "e::0": "array", "g::0": "object", "h::0": "sniffed", "h::1": "sniffed"}


def test_a_corrupt_member_is_skipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.xml", "<a><b>1</b></a>" * 50)
        z.writestr("b.xml", "<a><b>2</b></a>")
    data = bytearray(out.getvalue())
    at = data.find(b"a.xml") + 5
    data[at : at + 8] = b"\xff" * 8
    assert [n for n, _ in readers.unpack(bytes(data), "z.zip")] == ["z.zip!b.xml"]


def test_best_of_streams_equal_a_plain_sort(spark):
    from marlstone.operators import nearest as N

    rng = np.random.default_rng(3)
    c, q = rng.integers(0, 3, (3000, 8)).astype(float), rng.integers(0, 3, (700, 8)).astype(float)
    q[5] = 0
    names = [f"c{i}" for i in rng.permutation(3000)]
    for k in (1, 7):
        best = N.Best(700, k)
        for s in (0, 40, 1500):
            e = {0: 40, 40: 1500}.get(s, 3000)
            N.offer(best, c[s:e], q, q.astype(np.float32), pa.array(names[s:e]), True)
        got: dict = {}
        for batch in best.rows(pa.array(np.arange(700)), ["q", "id", "s"]):
            for r in batch.to_pylist():
                got.setdefault(r["q"], []).append((-r["s"], r["id"]))
        full = np.round(q @ c.T, 6)
        assert 5 not in got
        for i in range(700):
            assert got.get(i, []) == sorted((-s, n) for s, n in zip(full[i], names) if s > 0)[:k]


def test_index_rows_hold_one_chunk_each(spark):
    """Packed rows of a thousand chunks made a reader decode whole files at once."""
    docs = spark.createDataFrame([(f"c{i}", "one two two three") for i in range(50)], "chunk_id string, raw_text string")
    rows = R.lexical_index(docs).collect()
    assert len(rows) == 50 and all(len(r.tok) == 3 and sorted(r.tf) == [1, 1, 2] for r in rows)


def test_vectors_in_turn(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(size=(90, 4)), 1)
    v[:30] /= 4
    rows = spark.createDataFrame([(i, [float(x) for x in v[i]], None if i == 7 else i % 3) for i in range(90)], "id long, vec array<double>, label long")
    s = np.round(v @ v.T, 6)
    near = (s > 0.5) & ~np.eye(90, dtype=bool)
    count = lambda df: {r.id: r.n for r in df.groupBy("id").agg(F.sum("n").alias("n")).collect()}
    assert {r.id: r.density for r in M.density(rows, 0.5).collect()} == dict(enumerate(near.sum(1).tolist()))
    ran = R.past_vectors(rows, lambda ids, q, marks: lambda own, c, mark: iter([pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), len(q)))], names=["id", "n"])]), "id long, n long", held=11)
    assert count(ran) == {i: 90 for i in range(90)}
    named = {r.g: r.label for r in rows.select("label", F.xxhash64("label").alias("g")).distinct().collect()}
    got = {(named[r.g], r.donor): r.best for r in M.best_by_group(rows, "label").collect()}
    label = [None if i == 7 else i % 3 for i in range(90)]
    assert got == {(g, d): max(s[i, d] for i in range(90) if label[i] == g) for g in range(3) for d in range(90) if label[d] not in (None, g)}
    pairs = {(r.a, r.b): (r.sim, r.va) for r in M.pair_similarities(rows, "label", 0.3, "label").collect()}
    assert pairs == {(a, b): (s[a, b], label[a]) for a in range(90) for b in range(a + 1, 90) if label[a] is not None and label[a] == label[b] and s[a, b] >= 0.3}
    top = {(r.query_id, r["rank"]): r.id for r in R.dense_topk(rows, rows, 3, other="label", block=40).collect()}
    assert top == {(a, n): b for a in range(90) if a != 7 for n, (_, b) in enumerate(sorted((-s[a, b], b) for b in range(90) if label[b] not in (None, label[a]))[:3], 1)}


def test_facts_of_an_order_have_no_cap(spark, tmp_path):
    from marlstone.plans import registry

    rows = [(1, part, line) for part in range(30) for line in (1, 2, 3, 4)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted((r.part, r.line) for r in registry.queries()["facts_json"](spark, str(tmp_path)).collect())
    assert got == [(part, line) for _, part, line in sorted(rows) if line <= 3]


def test_long_folds_stay_linear(spark):
    """60,000 picks and 60,000 tasks of one scope: lists that grow at every step took minutes."""
    picks = X.datamix_select(spark.range(120_000).selectExpr("id div 2 AS batch", "id", "cast(id % 97 AS double) AS gap", "element_at(array('low', 'mid', 'high'), cast(id * 7 % 3 AS int) + 1) AS bin"))
    shares = {r.bin: r["count"] / 60_000 for r in picks.groupBy("bin").count().collect()}
    assert shares == pytest.approx({"low": 0.3, "mid": 0.4, "high": 0.3}, abs=0.01)
    tasks = spark.range(60_000).selectExpr("id", "1 AS s", "cast(id % 5 AS double) AS v")
    assert ST.densify(tasks, "s", "id", "v", 30.0, 15).groupBy().agg(F.count("*").alias("n"), F.sum("add").alias("add")).first().asDict() == {"n": 60_000, "add": 30}


def test_pairs_of_many_copies_leave_once(spark):
    """A passage of 30 words in 700 rows: 26 shingles each, one row for each pair, and none shuffled."""
    words = [f"w{i}" for i in range(30)]
    data = [(i, " ".join(words[: 30 - i % 3] + [f"own{i}x{k}" for k in range(i % 4)])) for i in range(700)] + [(900, "a b"), (901, "a b"), (902, "")]
    found = D.shingle_pairs(spark.createDataFrame(data, "id long, text string"), 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")
    got = {(r.a, r.b): r.jaccard for r in found.collect()}
    gram = lambda t: {tuple(t.split()[k : k + 4]) for k in range(max(1, len(t.split()) - 3))}
    sets = {i: gram(t) for i, t in data}
    assert len(got) == 700 * 699 // 2 + 1 and found.count() == len(got)
    assert all(got[p] == pytest.approx(len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]), abs=1e-6) for p in list(got)[::37])


def test_repeated_orders_and_lines_join_once(spark, tmp_path):
    from marlstone.plans import registry

    spark.range(40).selectExpr("1 AS o_orderkey", "7 AS o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(400).selectExpr("1 AS l_orderkey", "id % 8 AS l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = registry.queries()["round_robin_facts"](spark, str(tmp_path))
    assert sorted((r.grp, r.chunk, r.fact, r.place) for r in found.collect()) == [(7, 1, i, i + 1) for i in range(5)]
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert joined.index("Join") < joined.index("Aggregate")


def test_statistics_equal_a_count(spark):
    texts = ["one two two", "", None, "two Three", "--", "three three three"]
    rows = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "chunk_id string, raw_text string").repartition(3)
    got = {r.token: (r.df, r.cf, r.idf) for r in R.term_statistics(rows).collect()}
    idf = lambda df: round(max(0.0, math.log((3 - df + 0.5) / (df + 0.5) + 1)), 6)
    assert got == {"one": (1, 1, idf(1)), "two": (2, 3, idf(2)), "three": (2, 4, idf(2))}
