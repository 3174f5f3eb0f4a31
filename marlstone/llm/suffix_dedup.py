"""Repeated passages by distributed prefix doubling over a suffix array of words.

Two word positions get the same rank at length h iff the h words from them on are the same. Spark sorts the pairs
(rank at h of position p, rank at h of position p + h) by range; the place of a run of equal pairs in that order is
their rank at 2h, and a position whose pair is unique leaves, since no longer prefix of it can repeat either. The last
offset is cut so that the final length is the threshold itself; positions still tied then begin a repeat of at least
that many words. The position is part of the sort key, so a passage that a third of all documents hold is spread over
many tasks; runs that reach over the bounds of tasks are joined on the driver, which gets two rows a task.

The first ranks are those at `base` words: 128-bit hashes taken where the text lies. Before any of them moves, an exact
filter drops the text that can't hold a repeat: in every stretch of threshold words the gram of `anchor` words with the lowest
hash is an anchor, so two equal stretches have equal anchors, and only positions from which a stretch reaches an
anchor met twice stay in. Documents with the same words throughout are one document here, all of them repeats.

Defined cases
* Words are maximal runs of letters and digits in lower case, and single characters of scripts without spaces (see
  textvec.words); punctuation, signs and white space don't count.
* spans lists, in order, the merged word ranges [start, end) of the document's repeats, "12-80,95-150"; a repeat may lie
  in other documents or elsewhere in the same one, and all occurrences are reported, the first included.
* Documents without a repeat, with a null or short text have no row. Rows with a null doc_id take part under null.
  Repeated rows count as documents of their own with the same words, and so report all of their words.
* Texts of any length count whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import broadcast_if_small, drop_stash, stash

_TWO = np.uint64(0xD1B54A32D192ED03)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The lowest of every w values in a row."""
    out, size = x, 1
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - size :][: len(x) - w + 1])
    return out


def _anchors(threshold: int, base: int):
    """(doc_id, row key, words, 128-bit hash of them, anchor hashes) for each document of threshold words."""
    w = threshold - base + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in tv.chunks(texts):
                h, o = tv.words(texts.slice(a, b - a))
                g = tv.grams(h, np.array([0, len(h)]), base)[0] if len(h) >= base else np.zeros(0, np.uint64)
                rows = np.flatnonzero(np.diff(o) >= threshold)
                lengths, one, two, packed = [], [], [], []
                for i in rows:
                    s, e = int(o[i]), int(o[i + 1])
                    own = g[s : e - base + 1]
                    low = _window_min(own, w)
                    # A position is an anchor iff it holds the minimum of one of the windows that it lies in.
                    reach = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
                    best = ~_window_min(~reach, w)
                    at = np.flatnonzero(own == best)
                    packed.append((at.astype(np.int64), own[at]))
                    lengths.append(e - s)
                    ws = tv.mix(h[s:e] + np.arange(1, e - s + 1, dtype=np.uint64))
                    one.append(np.add.reduce(ws))
                    two.append(np.bitwise_xor.reduce(tv.mix(ws + _TWO)))
                if not len(rows):
                    continue
                offsets = pa.array(np.append(0, np.cumsum([len(p) for p, _ in packed])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(rows)),
                        batch.column(1).slice(a, b - a).take(pa.array(rows)),
                        pa.array(lengths, pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([g_ for _, g_ in packed]).view(np.int64))),
                    ],
                    names=["d", "k", "n", "f1", "f2", "anchors"],
                )

    return run


def _starts(threshold: int, anchor: int, base: int):
    """The ranks at base words of the positions from which threshold words reach an anchor met twice."""
    back = threshold - anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keys, texts, hot = part.column(0), part.column(1), part.column(2).to_pylist()
                h, o = tv.words(texts)
                if len(h) < anchor:
                    continue
                every = np.array([0, len(h)])
                g = tv.grams(h, every, anchor)[0]
                g1 = tv.grams(h, every, base)[0]
                g2 = tv.grams(tv.mix(h ^ _TWO), every, base)[0]
                ids, pos, r1, r2 = [], [], [], []
                for i, marks in enumerate(hot):
                    s, e = int(o[i]), int(o[i + 1])
                    m = e - s - anchor + 1
                    if not marks or m <= 0:
                        continue
                    own = g[s : s + m]
                    hit = np.flatnonzero(np.isin(own, np.array(marks, np.int64).view(np.uint64)))
                    # Every position of `base` words that a stretch over a hit goes over.
                    places = e - s - base + 1
                    edge = np.zeros(places + 1, np.int64)
                    np.add.at(edge, np.maximum(hit - back, 0), 1)
                    np.add.at(edge, np.minimum(hit + threshold - base + 1, places), -1)
                    p = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    ids.append(np.full(len(p), i))
                    pos.append(p)
                    r1.append(g1[s : s + places][p])
                    r2.append(g2[s : s + places][p])
                if not ids:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(np.concatenate(ids))),
                        pa.array(np.concatenate(pos).astype(np.int32)),
                        pa.array(np.concatenate(r1).view(np.int64)),
                        pa.array(np.concatenate(r2).view(np.int64)),
                    ],
                    names=["k", "p", "r1", "r2"],
                )

    return run


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of sorted rank pairs: rows (k, p, r) of the pairs that aren't unique in their partition, and of the first and
    the last pair in it, which a neighbour may hold too; for those two also a row with the pair and its number n.

    A rank is the partition's number and the row at which the run of equal pairs begins: it rises as the pairs do.
    """
    base = TaskContext.get().partitionId() << 40
    seen = start = size = 0
    pair = held = first = None

    def out(k, p, r):
        none = pa.nulls(len(k), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(p), pa.array(r), none, none, none], names=["k", "p", "r", "r1", "r2", "n"])

    def edge(start, pair, size):
        one = lambda v, kind: pa.array([v], kind)
        return pa.RecordBatch.from_arrays([one(None, pa.int64()), one(None, pa.int32()), one(base + start, pa.int64()), one(pair[0], pa.int64()), one(pair[1], pa.int64()), one(size, pa.int64())], names=["k", "p", "r", "r1", "r2", "n"])

    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        k, p, a, b = (batch.column(i).to_numpy() for i in range(4))
        new = np.ones(rows, bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new[0] = pair is None or (a[0], b[0]) != pair
        starts = np.flatnonzero(new)
        lead = int(starts[0]) if len(starts) else rows
        if lead:
            if held is not None:
                yield out(*held, np.array([base + start]))
                held = None
            yield out(k[:lead], p[:lead], np.full(lead, base + start))
            size += lead
        if len(starts):
            if pair is not None and first is None:
                first = (start, pair, size)
                if held is not None:
                    yield out(*held, np.array([base + start]))
            sizes = np.diff(np.append(starts, rows))
            keep = sizes > 1
            if pair is None and first is None and len(starts) > 1:
                first = (seen + int(starts[0]), (a[starts[0]], b[starts[0]]), int(sizes[0]))
                keep[0] = True
            start, size, pair = seen + int(starts[-1]), int(sizes[-1]), (a[-1], b[-1])
            of = np.repeat(keep, sizes)
            held = (k[-1:], p[-1:]) if size == 1 else None
            if size == 1:
                of[-1] = False
            at = lead + np.flatnonzero(of)
            if len(at):
                yield out(k[at], p[at], base + seen + np.repeat(starts, sizes)[at - lead])
        seen += rows
    if pair is not None:
        if held is not None:
            yield out(*held, np.array([base + start]))
        if first is not None:
            yield edge(*first)
        yield edge(start, pair, size)


def _rerank(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sorts the rank pairs (r1, r2); equal pairs share a rank, and unique ones leave: (k, p, r), and the written table that
    it reads. Equal pairs, however many, are spread over tasks by their positions."""
    ranked = stash(pairs.repartitionByRange("r1", "r2", "k", "p").sortWithinPartitions("r1", "r2").mapInArrow(_ties, "k long, p int, r long, r1 long, r2 long, n long"), "rank")
    runs = ranked.where("n IS NOT NULL").select("r", "r1", "r2", "n").orderBy("r").collect()  # two a task at the most
    fix, i = [], 0
    while i < len(runs):
        j = i
        while j + 1 < len(runs) and runs[j + 1][1:3] == runs[i][1:3]:
            j += 1
        many = j > i or runs[i].n > 1
        fix += [(x.r, runs[i].r if many else None) for x in runs[i : j + 1] if j > i or not many]
        i = j + 1
    fixes = F.broadcast(pairs.sparkSession.createDataFrame(fix, "r long, new long").withColumn("known", F.lit(True)))
    rows = ranked.where("k IS NOT NULL").join(fixes, "r", "left")
    return rows.where("known IS NULL OR new IS NOT NULL").select("k", "p", F.coalesce("new", "r").alias("r")), ranked


def repeated_passages(docs: DataFrame, threshold: int = 50, base: int = 16, anchor: int = 16) -> DataFrame:
    """(doc_id, n_words, repeated_words, spans) for every document with a repeat of at least threshold words."""
    base, anchor = max(1, min(base, threshold)), max(1, min(anchor, threshold))
    keyed = docs.select(F.col("doc_id").alias("d"), F.xxhash64("doc_id", "text").alias("k"), F.col("text").alias("t"))
    kind = dict(docs.dtypes)["doc_id"]
    found = stash(keyed.mapInArrow(_anchors(threshold, anchor), f"d {kind}, k long, n long, f1 long, f2 long, anchors array<long>"), "anchors")
    same = stash(found.groupBy("f1", "f2", "n").agg(F.min("k").alias("k"), F.count("*").alias("copies"), F.first("anchors").alias("anchors")), "same")

    hashes = same.select("k", F.explode("anchors").alias("g"))
    twice = hashes.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g")
    hot = stash(hashes.join(twice, "g").groupBy("k").agg(F.collect_set("g").alias("hot")), "hot")
    near = broadcast_if_small(hot)

    # Rows alike in doc_id and text share a key; one of them stands for all.
    first = keyed.select("k", "t").join(near, "k").dropDuplicates(["k"]).select("k", "t", "hot")
    pairs = stash(first.mapInArrow(_starts(threshold, anchor, base), "k long, p int, r1 long, r2 long"), "positions")
    h = base
    while True:
        ranks, files = _rerank(pairs)
        drop_stash(pairs)
        if h >= threshold:
            break
        step = min(h, threshold - h)
        ahead = Window.partitionBy("k").orderBy("p").rangeBetween(step, step)
        pairs = ranks.withColumn("r2", F.first("r").over(ahead)).where("r2 IS NOT NULL")
        pairs = stash(pairs.select("k", "p", F.col("r").alias("r1"), "r2"), "positions")
        drop_stash(files)
        h += step

    line = Window.partitionBy("k").orderBy("p")
    cut = F.when(F.col("p") - F.lag("p").over(line) <= threshold, 0).otherwise(1)
    islands = ranks.select("k", "p").withColumn("cut", cut).withColumn("i", F.sum("cut").over(line))
    spans = islands.groupBy("k", "i").agg(F.min("p").alias("s"), (F.max("p") + threshold).alias("e"))
    by_doc = spans.groupBy("k").agg(
        F.sum(F.col("e") - F.col("s")).alias("repeated"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "e"))), lambda x: F.concat_ws("-", x["s"], x["e"])), ",").alias("spans"),
    )
    members = found.select("d", "k", "n", "f1", "f2")
    out = members.join(same.select("f1", "f2", "n", F.col("k").alias("first"), "copies"), ["f1", "f2", "n"])
    out = out.join(by_doc.withColumnRenamed("k", "first"), "first", "left")
    many = F.col("copies") > 1
    return out.where(many | F.col("spans").isNotNull()).select(
        F.col("d").alias("doc_id"),
        F.col("n").alias("n_words"),
        F.when(many, F.col("n")).otherwise(F.col("repeated")).cast("long").alias("repeated_words"),
        F.when(many, F.concat(F.lit("0-"), F.col("n"))).otherwise(F.col("spans")).alias("spans"),
    )
