import random

import pytest

from marlstone.llm import bpe as B


@pytest.fixture(scope="module")
def tokens():
    return B.read_ranks()


@pytest.fixture(scope="module")
def coder(tokens):
    return B.Bpe(tokens, *B.merge_tables(tokens))


def merge_by_rank(ids, word):
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        ranks = [ids.get(parts[i] + parts[i + 1], 1 << 30) for i in range(len(parts) - 1)]
        k = ranks.index(min(ranks))
        if ranks[k] == 1 << 30:
            break
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [ids[p] for p in parts]


def test_every_prefix_has_the_last_token_of_its_own_encoding(tokens, coder):
    ids = {t: i for i, t in enumerate(tokens)}
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abcdeinorst' éß中") for _ in range(rng.randint(1, 14))).encode()
        last = coder.last_tokens(word)
        for end in range(1, len(word) + 1):
            assert last[end] == merge_by_rank(ids, word[:end])[-1]


def test_equals_tiktoken(tokens, coder):
    tiktoken = pytest.importorskip("tiktoken")
    other = tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab c  \n\t's'llve12é中😀-=<|>") for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    for text in [*texts, "", " ", "\n", " a", "a ", "<|endoftext|>", "x" * 5000]:
        packed = coder.encode_bytes(text)
        ids = [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]
        assert ids == other.encode_ordinary(text)
        assert coder.decode_bytes(ids).decode() == text


def test_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = B.bpe_encode(docs)
    assert out.where("NOT round_trip OR n_tokens <> size(token_ids)").count() == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in B.bpe_decode(out).collect()} == texts


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "hello  world", 1), (3, "hello  world", 1), (None, "é" * 9000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __text int")
    got = sorted(((r.doc_id or -1), r.n_tokens, r.round_trip) for r in B.bpe_encode(docs).collect())
    assert got == [(-1, got[0][1], True), (1, None, None), (2, 0, True), (3, 3, True), (3, 3, True)]
    assert B.bpe_encode(docs.limit(0)).count() == 0
    bad = spark.createDataFrame([(1, [50255, 999999, None, -4, 64]), (2, None)], "doc_id long, token_ids array<int>")
    assert [r.text is None for r in B.bpe_decode(bad).orderBy("doc_id").collect()] == [False, True]


def test_vocabularies_of_one_size_are_told_apart(spark, tmp_path):
    import base64

    def vocabulary(name, merges):
        tokens = [bytes([i]) for i in range(256)] + merges
        path = tmp_path / name
        path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
        return str(path)

    docs = spark.createDataFrame([(1, "abab")], "doc_id long, text string").coalesce(1)
    one, two = vocabulary("one", [b"ab", b"xy"]), vocabulary("two", [b"ba", b"xy"])
    assert B.bpe_encode(docs, one).first().token_ids == [256, 256]
    assert B.bpe_encode(docs, two).first().token_ids == [97, 256, 98]


def test_megabytes_without_a_space(spark, monkeypatch):
    monkeypatch.setattr(B, "CACHE_BYTES", 1 << 16)
    texts = ["x" * 5_000_000, "ab1" * 700_000, " " * 2_000_000 + "end", "\u6211\u4eec" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.round_trip for r in B.bpe_encode(docs).select("round_trip").collect())
    tokens = B.read_ranks()
    coder = B.Bpe(tokens, *B.merge_tables(tokens))
    for i in range(3000):
        coder.encode_bytes(f"made{i} up{i} words{i}")
    assert coder.held <= (1 << 16) + 2000
