import math
import re
import zlib
from hashlib import md5

import pytest

import corpus_pipeline as C
from marlstone.llm import bpe, line_dedup, mixing, quality

from .test_ngram_join import classes, gram_set, links

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def good(text):
    ws = re.split(r"[ \n\t\r]+", text or "")
    visible = sum(map(len, ws))
    if not visible:
        return False
    stutter = sum(a == b for a, b in zip(ws, ws[1:]))
    upper = sum(c.isupper() for c in text)
    fresh = sum(len(set(ws[i : i + 200])) for i in range(0, len(ws), 200))
    return not (
        sum(c in quality.SYMBOLS for c in text) > 0.05 * len(text)
        or (upper >= 20 and upper > 0.3 * visible)
        or (stutter >= 5 and stutter > 0.08 * len(ws))
        or (len(ws) >= 50 and fresh < 0.4 * len(ws))
        or visible > 60 * len(ws)
    )


def unrepeated(rows):
    seen, out = set(), []
    for d, text, *rest in sorted(rows, key=lambda r: r[0]):
        kept = []
        lines = text.split("\n")
        for line in lines:
            if not line.strip(" "):
                kept.append(line)
            elif line not in seen:
                seen.add(line)
                kept.append(line)
        if len(kept) < len(lines) and not "".join(kept).strip(" "):
            continue
        text = "\n".join(kept)
        out.append((d, text, *rest[:-1], len(text)))
    return out


def one_of_each(rows):
    root = classes(links([(r[0], r[1]) for r in rows]))
    return [r for r in rows if root.get(r[:2], r[:2]) == r[:2]]


def mixture(rows):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + r[4]
    weight = {s: math.sqrt(z) for s, z in size.items()}
    live, amount, left = dict(weight), {}, float(sum(size.values()))
    while True:  # clamp, and pour what is left over again
        level = left / sum(live.values())
        over = [s for s in live if level * live[s] >= 3.0 * size[s]]
        if not over:
            break
        for s in over:
            amount[s] = 3.0 * size[s]
            left -= amount[s]
            del live[s]
    amount |= {s: level * w for s, w in live.items()}
    out = []
    for r in rows:
        epochs = round(amount[r[3]] / size[r[3]], 9)
        u = int(md5(f"{mixing.SEED}:{r[0]}".encode()).hexdigest()[:8], 16) / 2**32
        out += [r] * (int(epochs) + (u < round(epochs - int(epochs), 9)))
    return out


def test_run_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = mixture(one_of_each(unrepeated([r for r in rows if good(r[1])])))
    tokens = bpe.read_ranks()
    coder = bpe.Bpe(tokens, *bpe.merge_tables(tokens))
    want = sorted((r[0], r[2], r[3], zlib.crc32(coder.encode_bytes(r[1]))) for r in rows)
    import numpy as np

    got = sorted((r.doc_id, r.lang, r.source, zlib.crc32(np.array(r.token_ids, np.int32).tobytes())) for r in C.run(spark, sf).collect())
    assert got == want and want


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stages_on_edge_rows(spark, name):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "same line here\nsame line here", "en", "a", 29), (3, "same line here\nsame line here", "en", "a", 29), (None, "no id at all", "en", None, 12), (4, "é" * 40000, "en", "b", 40000), (5, "one two three\n\nfour", "en", "b", 19)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", k int, r int")
    stage = dict(C.STAGES)[name]
    out = stage(spark, docs, "/root/testdata/sf0.001")
    got = out.collect()
    if name != "bpe_encoding":
        assert out.columns == docs.columns
    texts = sorted((r.doc_id or -1) for r in got)
    want = {
        "quality_rules": [-1, 3, 3, 5],
        "line_dedup": [-1, 1, 2, 3, 3, 4, 5],
        "near_copies": [-1, 1, 2, 3, 3, 4, 5],
        "bpe_encoding": [-1, 1, 2, 3, 3, 4, 5],
    }
    if name in want:
        assert texts == want[name]
    if name == "line_dedup":
        assert {r.doc_id: (r.text, r.n_chars) for r in got}[3] == ("same line here", 14)
        assert {r.doc_id: r.text for r in got}[5] == "one two three\n\nfour"
    assert stage(spark, docs.limit(0), "").count() == 0


def test_gram_set_is_what_the_join_compares():
    assert gram_set("A b") == {("a", "b")}


def test_line_bitmap_of_a_long_document(spark):
    lines = [f"line {i % 700}" for i in range(3000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "line 3\nnew")], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_kept, r.keep_bitmap) for r in line_dedup.line_dedup(docs).collect()}
    assert got == {1: (3000, 700, "0,700,2300"), 2: (2, 1, "1,1")}


def test_mixing_clamps_and_pours_again(spark):
    docs = spark.createDataFrame([(1, "a", 100), (2, "b", 1000), (3, "c", 10), (4, None, 0)], "doc_id long, source string, n_chars long")
    got = {r.s: r.epochs for r in mixing.source_epochs(docs, {"a": 0.5, "b": 0.25, "c": 0.25}, 2.0).collect()}
    assert got == {"a": 2.0, "c": 2.0, "b": pytest.approx((1110 - 220) / 1000), None: 0.0}
