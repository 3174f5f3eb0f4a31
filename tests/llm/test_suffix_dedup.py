import random

import numpy as np
import pytest

from marlstone.llm import suffix_dedup as S
from marlstone.llm import textvec as tv

from .test_ngram_join import words


def brute(rows, threshold):
    seen = {}
    docs = [words(t) for _, t in rows]
    for i, ws in enumerate(docs):
        for p in range(len(ws) - threshold + 1):
            seen.setdefault(tuple(ws[p : p + threshold]), []).append((i, p))
    starts = {}
    for at in seen.values():
        if len(at) > 1:
            for i, p in at:
                starts.setdefault(i, []).append(p)
    out = []
    for i, ps in starts.items():
        spans = []
        for p in sorted(ps):
            if spans and p <= spans[-1][1]:
                spans[-1][1] = p + threshold
            else:
                spans.append([p, p + threshold])
        out.append((rows[i][0], len(docs[i]), sum(e - s for s, e in spans), ",".join(f"{s}-{e}" for s, e in spans)))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_window_min():
    x = np.random.default_rng(1).integers(0, 99, 60).astype(np.uint64)
    for w in range(1, 40):
        assert S._window_min(x, w).tolist() == [x[i : i + w].min() for i in range(61 - w)]


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["Über den Fluß, x", None, "", "a-b a", "  x "]
    h, o = tv.words(pa.array(texts))
    flat = [w for t in texts for w in words(t)]
    assert np.diff(o).tolist() == [len(words(t)) for t in texts]
    by = {}
    for w, x in zip(flat, h):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)


def test_against_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(S.repeated_passages(docs)) == brute(rows, 50)


def test_against_brute_force_on_random_texts(spark):
    rng = random.Random(11)
    rows = []
    for d in range(60):
        ws = [rng.choice("abc") for _ in range(rng.randint(0, 120))]
        if d % 3 == 0:
            ws += ["z"] * rng.randint(0, 40)
        rows.append((d, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold, base, anchor in ((9, 4, 4), (20, 1, 16), (7, 1, 2), (5, 16, 16)):
        assert got(S.repeated_passages(docs, threshold, base, anchor)) == brute(rows, threshold)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranks_of_sorted_pairs(spark, parts):
    """Runs that reach over many tasks, single pairs at their bounds, and nothing at all."""
    rng = random.Random(parts)
    values = [rng.choice([(1, 1), (1, 2), (5, rng.randint(0, 400)), (7, 7), (-9, 3)]) for _ in range(3000)] + [(50 + i, 0) for i in range(200)]
    frame = spark.createDataFrame([(i % 50, i, *v) for i, v in enumerate(values)], "k long, p int, r1 long, r2 long")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        ranks, _ = S._rerank(frame)
        found = {r.p: r.r for r in ranks.collect()}
        assert S._rerank(frame.limit(0))[0].count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert set(found) == {i for i, v in enumerate(values) if values.count(v) > 1}
    by = {}
    for i, r in found.items():
        assert by.setdefault(r, values[i]) == values[i]
    assert [by[r] for r in sorted(by)] == sorted(set(by.values())) and len(by) == len(set(by.values()))


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "short text"), (4, long), (4, long), (None, long.upper() + "!"), (5, " ".join(f"v{i}" for i in range(70)))]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, k int")
    assert got(S.repeated_passages(docs)) == sorted([(4, 60, 60, "0-60"), (4, 60, 60, "0-60"), (None, 60, 60, "0-60")], key=str)
    assert S.repeated_passages(docs.limit(0)).count() == 0


def test_texts_of_megabytes(spark):
    long = " ".join(f"w{i * 7 % 99991}" for i in range(600_000))
    shared = " ".join(f"s{i}" for i in range(55))
    rows = [(1, long), (2, "x" * 3_000_000), (3, shared + " end"), (4, "other start " + shared), (5, "我" * 60 + "们"), (6, "在" + "我" * 55)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(S.repeated_passages(docs)) == brute(rows, 50)
