import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute

from marlstone.llm import toxicity as X


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.where("pmod(xxhash64(doc_id, 9), 3) = 0")
    rest = labels.join(held, "doc_id", "left_anti")
    got = {r.doc_id: r.toxic for r in X.toxicity(docs, rest).collect()}
    # Documents of quality 0 had their words replaced by junk after they were labelled.
    pairs = [(got[r.doc_id], bool(r.toxic)) for r in held.where("quality = 1").collect()]
    hit = sum(a and b for a, b in pairs)
    print(len(pairs), hit, sum(a for a, _ in pairs), sum(b for _, b in pairs))
    assert hit >= 0.9 * sum(b for _, b in pairs)
    assert hit >= 0.9 * sum(a for a, _ in pairs)


def test_walk_finds_a_word_that_no_label_names(spark):
    rng = random.Random(1)
    plain = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for d in range(600):
        ws = [rng.choice(plain) for _ in range(40)]
        if d % 6 == 0:
            ws += rng.sample(["vilea", "vileb", "vilec"], 2) + (["hidden"] if d >= 120 else [])
        rows.append((d, " ".join(ws)))
        if d < 120:
            labels.append((d, 1, int(d % 6 == 0)))
    rows += [(1000, "hidden hidden plain1"), (1001, None), (1002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in X.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(out[d].toxic == (d % 6 == 0) for d in range(600))
    assert out[1000].toxicity > 0.3 and out[1001].toxicity == out[1002].toxicity == 0


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "a b", 2), (2, "a b", 3), (2, "a b", 3)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert X.toxicity(docs, labels).where("toxic OR toxicity <> 0").count() == 0
    assert X.toxicity(docs, labels).count() == 4
    assert X.toxicity(docs.limit(0), labels).count() == 0
    assert X.toxicity(docs, labels.limit(0)).count() == 4


def corpus(rng, toxic_words, docs=900, every=9, toxic_per_doc=3, labelled=450):
    """Documents of ordinary words, each ninth with some toxic ones."""
    plain = [f"plain{i:03d}x" for i in range(300)]
    rows, labels = [], []
    for d in range(docs):
        ws = [rng.choice(plain) for _ in range(30)]
        if d % every == 0:
            ws += rng.sample(toxic_words, toxic_per_doc)
        rows.append((d, " ".join(ws)))
        if d < labelled:
            labels.append((d, 1, int(d % every == 0)))
    return rows, labels


def test_a_broad_vocabulary_is_found(spark):
    """A hundred toxic words, each in about one in a hundred of the toxic documents."""
    words = [f"{a}{b}ugh" for a in "bcdfghjkmn" for b in ("aqua", "elmo", "ivor", "opus", "urdu", "yarn", "zeta", "kilo", "mira", "nova")]
    rows, labels = corpus(random.Random(3), words, docs=9000, labelled=9000, toxic_per_doc=1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.toxic for r in X.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    toxic = [out[d] for d in range(0, 9000, 9)]
    assert sum(toxic) >= 0.6 * len(toxic)
    assert not any(out[d] for d in range(9000) if d % 9)


def brute_induce(rows, sample, shift=2.0, steps=6, restart=0.3, support=4, every_pair=False):
    """Polarities by dictionaries, in the words of the docstring."""

    def terms(text):
        out = set()
        for w in (text or "").lower().split():
            whole, _, heads = X.tv.words(pa.array([w]), X.PREFIXES)
            out |= {int(x) for x in (*whole, *heads[0]) if x}
        return out

    def sure(k, n, base, tested):
        p = k / n
        part = lambda x, y: x * math.log(x / y) if x > 0 else 0.0
        return n * (part(p, base) + part(1 - p, 1 - base)) >= math.log(max(2, tested))

    held = [(terms(t), x) for t, x in sample]
    base = sum(x for _, x in held) / len(held)
    n, tox = Counter(t for s, _ in held for t in s), Counter(t for s, x in held if x for t in s)
    tested = sum(v >= support for v in n.values())
    up = {t: tox[t] / n[t] for t in n if n[t] >= support and tox[t] >= support and tox[t] / n[t] >= 0.8 and sure(tox[t], n[t], base, tested)}
    sets = [terms(t) for _, t in rows]
    marked = [bool(s & up.keys()) for s in sets]
    n, both = Counter(t for s in sets for t in s), Counter(t for s, m in zip(sets, marked) if m for t in s)
    total, share = len(sets), sum(marked)
    met = [t for t in both if both[t] >= support]
    nodes = [t for t in met if t in up or (both[t] * total > shift * n[t] * share and sure(both[t], n[t], share / total, len(met)))]
    pair = Counter((a, b) for s in sets for a in s if a in set(nodes) for b in s if b in set(nodes) and a != b and (every_pair or a in up or b in up))
    w = {}
    for (a, b), c in pair.items():
        if (every_pair or c > 1) and (v := math.log(c * total / (n[a] * n[b])) - math.log(shift)) > 0:
            w.setdefault(a, {})[b] = v
    every = sum(n[t] for t in nodes)
    p0, q0 = {t: 1 / len(up) if t in up else 0.0 for t in nodes}, {t: (n[t] - both[t]) / every for t in nodes}
    p, q = dict(p0), dict(q0)
    for _ in range(steps):
        mp, mq = Counter(), Counter()
        for a, out in w.items():
            for b, v in out.items():
                mp[b] += p[a] * both[a] / n[a] * v / sum(out.values())
                mq[b] += q[a] * both[a] / n[a] * v / sum(out.values())
        p, q = {t: restart * p0[t] + (1 - restart) * mp[t] for t in nodes}, {t: q0[t] + (1 - restart) * mq[t] for t in nodes}
    polar = {t: 2 * p[t] / (p[t] + q[t]) - 1 for t in nodes if p[t] + q[t] > 0}
    for t, s in up.items():
        polar[t] = max(polar.get(t, 0.0), s)
    return {t: v for t, v in polar.items() if v > 1e-12}


def test_polarities_equal_a_plain_walk(spark):
    rows, labels = corpus(random.Random(5), ["vileness", "vilest", "scumbag", "grot", "mopeful", "hiddenish"])
    rows += [(d, "plain001x vilest hiddenish plain002x plain003x") for d in (2000, 2001)] + [(2002, "grot " * 5), (2003, None), (2004, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    terms, weights, threshold = X.induce(docs, labels)
    sample = [(r.t, r.x) for r in X.label_sample(docs, labels, 20_000).where("part > 0").collect()]
    want = brute_induce(rows, sample)
    got = {int(t) & (2**64 - 1): w for t, w in zip(terms, weights)}
    assert got.keys() == want.keys() and len(got) > 6
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want) and 0 < threshold < 10


def test_long_texts_and_ties(spark):
    rows, labels = corpus(random.Random(7), ["vileness", "scumbag", "grotty"], docs=500)
    long = " ".join(f"plain{i % 300:03d}x" for i in range(400_000))
    rows += [(3000, long), (3001, long + " vileness"), (3002, long), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = X.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and sum(r.doc_id == 0 and r.toxic for r in out) == 2
    assert got[3001].toxicity > got[3000].toxicity == got[3002].toxicity


def test_nodes_that_are_no_seeds_are_joined(spark, monkeypatch):
    """Words that no label names, met with seeds, with each other without any seed, and once only."""
    monkeypatch.setattr(X, "SIDE", 5, raising=False)
    monkeypatch.setattr(X, "BAND", 2, raising=False)
    rows, labels = corpus(random.Random(11), ["vileness", "scumbag", "grotty", "mopeful"])
    rows = [(d, t + (" hiddenish lurking" if d >= 450 and d % 9 == 0 and d % 2 else " covertly" if d >= 450 and d % 9 == 0 else "")) for d, t in rows]
    rows += [(2000 + d, "lurking hiddenish plain001x plain002x") for d in range(6)] + [(3000, "covertly hiddenish"), (3001, "covertly hiddenish lurking vileness")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    terms, weights, _ = X.induce(docs, labels)
    sample = [(r.t, r.x) for r in X.label_sample(docs, labels, 20_000).where("part > 0").collect()]
    want, cut = brute_induce(rows, sample, every_pair=True), brute_induce(rows, sample)
    got = {int(t) & (2**64 - 1): w for t, w in zip(terms, weights)}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
    assert any(abs(want[t] - cut.get(t, 0)) > 1e-3 for t in want)


def test_squares_hold_every_pair():
    """Sets of all sizes, some many times, over several squares: products with the edges' matrix equal dense ones."""
    rng, nodes, side, total, shift = np.random.default_rng(2), 2500, 900, 200, 2.0
    sets = [np.sort(rng.choice(nodes, size, False)) for size in (*range(2, 40), 150, 400, 1500, 2500)]
    sets += [np.r_[0:850, 900:920], np.r_[0:20, 900:1750]]
    docs = rng.integers(1, 300, len(sets))
    member = np.zeros((len(sets), nodes))
    for i, s in enumerate(sets):
        member[i, s] = 1
    n = np.maximum((member.T @ docs).astype(np.int64) // 3, 1)
    batch = pa.RecordBatch.from_arrays([X._binary(np.concatenate(sets).astype(np.uint32), np.array([len(s) for s in sets])), pa.array(docs)], names=["k", "docs"])
    parts = pa.Table.from_batches(X._parts(side, most=500)([batch]))
    edges = []
    for square in range(6):
        mine = parts.filter(pa.compute.equal(parts["square"], square))
        edges += X._cells(n, total, shift, side, 64, most=700)(mine.to_batches())
    both = member.T @ (docs[:, None] * member)
    np.fill_diagonal(both, 0)
    ratio = both * total / (shift * n[:, None] * n)
    w = np.where(ratio > 1, np.log(np.maximum(ratio, 1)), 0)
    vectors = rng.random((2, nodes))
    got = np.zeros((2, nodes))
    for out in X._times(n, total, shift, side, vectors)(edges):
        got[:, out.column(0).to_numpy()] += np.array([out.column(1).to_numpy(), out.column(2).to_numpy()])
    assert 0 < (w > 0).sum() < nodes * (nodes - 1) and np.allclose(got, vectors @ w, rtol=1e-9)
