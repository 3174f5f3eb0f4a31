import random

import pytest
import regex

from marlstone.llm import ngram_join as J

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RUNS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|(?:[0-9a-z]|(?![\p{Z}\p{P}\p{S}\p{Cc}\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])[\u0080-\U0010ffff])+")


def words(text):
    return RUNS.findall((text or "").lower())


def gram_set(text, n=3):
    ws = words(text)
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) or frozenset([tuple(ws)])


def links(rows, threshold=0.5):
    """{(doc_id, text): the others at the threshold}, by brute force over shared n-grams."""
    docs = sorted({(d, t) for d, t in rows if d is not None})
    sets = {x: gram_set(x[1]) for x in docs}
    index = {}
    for x, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(x)
    out = {}
    for x, s in sets.items():
        for y in {y for g in s for y in index[g]} - {x}:
            o = sets[y]
            both = len(s & o)
            if both >= threshold * (len(s) + len(o) - both):
                out.setdefault(x, set()).add(y)
    return out


def classes(near):
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, bs in near.items():
        for b in bs:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in near}


def want(rows):
    near = links(rows)
    return sorted((x[0], root[0], len(near[x])) for x, root in classes(near).items())


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_recall_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    full = want([(r.doc_id, r.text) for r in docs.collect()])
    found = got(J.ngram_jaccard_join(docs))
    assert len(full) > 50
    assert sum(n for _, _, n in found) >= 0.97 * sum(n for _, _, n in full)
    most = {d: n for d, _, n in full}
    assert all(n <= most.get(d, 0) for d, _, n in found)
    classes_ = {(d, c) for d, c, _ in full}
    assert len({(d, c) for d, c, _ in found} & classes_) >= 0.97 * len(classes_)


@pytest.mark.parametrize("block, size", [(4096, 16 << 20), (16, 4000)])
def test_large_group_splits_and_blocks(spark, monkeypatch, block, size):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "BLOCK_BYTES", size)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(100):
        own = list(base)
        own[d % 120] = f"x{d}"
        rows.append((d, " ".join(own), None, None, None))
    rows += [(1000 + d, " ".join(f"u{d}v{i}" for i in range(30)), None, None, None) for d in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(J.ngram_jaccard_join(docs, bucket=8)) == want([r[:2] for r in rows]) == [(d, 0, 99) for d in range(100)]


def test_nodes_split_until_small_however_deep(spark):
    """Random sets that share many tokens: many levels, and nothing lost that brute force finds at a high similarity."""
    rng = random.Random(3)
    rows = []
    for c in range(40):
        base = [f"c{c}w{rng.randint(0, 400)}" for _ in range(200)]
        for _ in range(12):
            own = list(base)
            for _ in range(4):
                own[rng.randrange(200)] = f"z{rng.random()}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, full = got(J.ngram_jaccard_join(docs, bucket=2)), want(rows)
    assert {(d, c) for d, c, _ in found} == {(d, c) for d, c, _ in full}
    assert sum(r[2] for r in found) >= 0.97 * sum(r[2] for r in full)


def test_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "...", "en", "a", 3), (4, "One two", "en", "a", 7), (5, "one TWO", None, "a", 7), (None, "one two", "en", "a", 7), (6, "a b c d e f", "en", "b", 11), (6, "a b c d e f", "en", "b", 11), (7, "A b c d e f!", "en", "b", 12)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", node string, d string")
    assert got(J.ngram_jaccard_join(docs)) == [(4, 4, 1), (5, 4, 1), (6, 6, 1), (7, 6, 1)]
    kept = J.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 6]
    empty = docs.limit(0)
    assert J.ngram_jaccard_join(empty).count() == 0 and J.drop_near_copies(empty).count() == 0


def test_rows_that_share_an_id_and_ids_of_text(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [("1", one), ("1", two), ("2", one + " more"), ("3", two + " more"), ("4", "something else altogether")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert got(J.ngram_jaccard_join(docs)) == sorted([("1", "1", 1), ("1", "1", 1), ("2", "1", 1), ("3", "1", 1)])
    assert sorted((r.doc_id, r.text) for r in J.drop_near_copies(docs).collect()) == sorted([rows[0], rows[1], rows[4]])


def test_texts_of_megabytes_and_of_scripts_without_spaces(spark):
    long = " ".join(f"w{i * 7 % 99991}" for i in range(700_000))
    one_word = "x" * 3_000_000
    han = "我们在城里买了很多新鲜的水果然后回家做饭"
    rows = [(1, long), (2, "start " + long), (3, one_word), (4, one_word), (5, one_word + "y"), (6, han), (7, han[:-1] + "。"), (8, "no break — “quoted” text here"), (9, "no break quoted text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(J.ngram_jaccard_join(docs)) == [(1, 1, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1), (6, 6, 1), (7, 6, 1), (8, 8, 1), (9, 8, 1)]


def test_components(spark):
    pairs = spark.createDataFrame([(i, i + 1, 1.0) for i in range(1, 30)] + [(100, 101, 1.0)], "doc_a long, doc_b long, jaccard double")
    assert dict(J.components(pairs).collect()) == {**{i: 1 for i in range(1, 31)}, 100: 100, 101: 100}


def test_components_of_long_chains(spark):
    shuffled, down = list(range(400)), [0, *range(299, 0, -1)]
    random.Random(5).shuffle(shuffled)
    pairs = [*zip(shuffled, shuffled[1:]), *((1000 + a, 1000 + b) for a, b in zip(down, down[1:]))]
    frame = spark.createDataFrame([(min(x), max(x), 1.0) for x in pairs], "doc_a long, doc_b long, jaccard double")
    assert dict(J.components(frame).collect()) == {**dict.fromkeys(range(400), 0), **dict.fromkeys(range(1000, 1300), 1000)}
