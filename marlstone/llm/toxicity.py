"""Toxicity by lexicon induction.

Terms are whole words and the first 4 to 7 bytes of longer ones, so that a lexicon of stems covers forms that it never
met. Seeds come from the labels: terms whose labelled documents are toxic at 0.8 at least, where the counts speak against
the labels' own share of toxic documents. Over all documents, every term is counted, in all and with a seed; the terms
that seeds draw (positive pointwise mutual information with having a seed, by more than chance leaves to so many
terms) are the nodes of a graph. Any two nodes are joined by positive pointwise mutual information (less log shift, for
words of one language always attract) of occurring in the same document, in one document too. Documents without a seed
are one more node, the clean pole.
Pairs are counted in squares of nodes, a task each; documents with the same nodes are counted as one set, so that a long
text that thousands copy is spread into pairs once. No pair is written as a row: a square leaves the bits of its edges.
Random walks with restart start at the seeds and at the clean pole. A step picks one of the term's documents: without a
seed it ends at the pole, else it goes on along the graph; the pole sends walks to terms as its documents hold them.
The share of a term's visits that come from the toxic side gives its polarity; a seed's is at least its share in the
labels. A document scores the sum, over its distinct words, of the highest polarity among the word's terms; it is toxic
from the threshold on that is best on the third of the labelled sample that chose no seeds.

"Speak against" and "more than chance leaves" are one test: n times the divergence of the share from the general one
reaches the log of the number of terms tested. A term in a handful of documents passes it if all of them agree, whatever
the size of the corpus; there is no share of documents that it has to reach, and no number of seeds or nodes.

max_labelled documents with labels choose seeds and threshold (hash sample of the labels, without near copies, which
would make every word of a copied toxic text a seed). support is the least number of documents, labelled or with a seed,
that a term is tested from. Every worker holds the nodes, two vectors of the walk and the lexicon, 16 bytes a term each.

Defined cases
* A null or empty text scores 0 and isn't toxic. Rows without a doc_id are scored; they can't be labelled.
* Without labels, or without seeds among them, every score is 0. Null labels are left out; repeated labels of one
  document count once, as toxic if any says so. Repeated documents count as often as they are there.
* Texts of any length count whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import drop_stash, stash

PREFIXES = (4, 5, 6, 7)
BITS = 22
SIDE = 6144  # nodes along a square of pairs, which a task counts in 4 bytes each
BAND = 32
EDGES = ["a", "b", "size", "held", "bits", "counts", "more"]


class _Set:
    """Membership of 64-bit hashes, with a bit table before the search."""

    def __init__(self, values):
        self.values = np.unique(np.asarray(values, np.int64)).view(np.uint64)
        self.values.sort()
        self.table = np.zeros(1 << BITS, bool)
        self.table[self.values & np.uint64((1 << BITS) - 1)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in x of members, their indices in values)."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[x & np.uint64((1 << BITS) - 1)])
        k = np.searchsorted(self.values, x[at])
        k[k == len(self.values)] = 0
        ok = self.values[k] == x[at]
        return at[ok], k[ok]


def _terms(texts: pa.Array):
    """(row of each word, matrix of its terms) of a chunk."""
    whole, o, heads = tv.words(texts, PREFIXES)
    return np.repeat(np.arange(len(texts)), np.diff(o)), np.column_stack([whole, heads])


def _distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled documents with each term, toxic and in all."""
    terms, tox = [], []
    for batch in batches:
        flags = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in tv.chunks(batch.column(0)):
            rows, matrix = _terms(batch.column(0).slice(a, b - a))
            rows = np.repeat(rows, matrix.shape[1])
            r, t = _distinct(rows, matrix.ravel())
            terms.append(t[t > 0])
            tox.append(flags[a:b][r[t > 0]])
    if terms:
        values, inverse = np.unique(np.concatenate(terms), return_inverse=True)
        toxic = np.bincount(inverse, np.concatenate(tox)).astype(np.int64)
        n = np.bincount(inverse)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(toxic), pa.array(n)], names=["term", "toxic", "n"])


def _counts(seeds: np.ndarray, most: int = 1 << 18):
    """Partial counts of documents with each term, in all and with a seed, about `most` terms at a time; term null counts
    the documents."""
    marks = _Set(seeds)

    def summed(held):
        values, inverse = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return values, *(np.bincount(inverse, np.concatenate([h[i] for h in held])).astype(np.int64) for i in (1, 2))

    def run(batches):
        held, size, docs, with_seed = [], 0, 0, 0
        for batch in batches:
            for a, b in tv.chunks(batch.column(0), tv.CHUNK >> 2):
                rows, matrix = _terms(batch.column(0).slice(a, b - a))
                flat, width = matrix.ravel(), matrix.shape[1]
                hit, _ = marks.find(flat)
                marked = np.zeros(b - a, bool)
                marked[rows[hit // width]] = True
                docs += b - a
                with_seed += int(marked.sum())
                # Whole words and prefixes of each length have hashes of their own, so each kind is counted by itself. One
                # sort by a hash of row and term finds the distinct pairs; a shared hash is as rare as 2^-64 a pair.
                salt = tv.mix(rows.astype(np.uint64) + np.uint64(1))
                for j in range(width):
                    some = np.flatnonzero(matrix[:, j])
                    _, first = np.unique(matrix[some, j] ^ salt[some], return_index=True)
                    first = some[first]
                    values, inverse = np.unique(matrix[first, j], return_inverse=True)
                    n = np.bincount(inverse, minlength=len(values))
                    held.append((values, n, np.bincount(inverse, marked[rows[first]], minlength=len(values)).astype(np.int64)))
                    size += len(values)
                if size > 2 * most:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > most:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1]), pa.array(held[0][2])], names=["term", "n", "both"])
                        held, size = [], 0
        if held:
            values, n, both = summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n), pa.array(both)], names=["term", "n", "both"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs]), pa.array([with_seed])], names=["term", "n", "both"])

    return run


def _sets(nodes: np.ndarray):
    """The set of nodes of each document that has two or more, as the bytes of their places."""
    found = _Set(nodes)

    def run(batches):
        for batch in batches:
            for a, b in tv.chunks(batch.column(0), tv.CHUNK >> 2):
                rows, matrix = _terms(batch.column(0).slice(a, b - a))
                at, k = found.find(matrix.ravel())
                r, k = _distinct(rows[at // matrix.shape[1]], k)
                size = np.bincount(r, minlength=b - a)
                k, size = k[size[r] > 1], size[size > 1]
                yield pa.RecordBatch.from_arrays([_binary(k.astype(np.uint32), size)], names=["k"])

    return run


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Values in rows of the given sizes, as binary."""
    ends = np.append(0, np.cumsum(sizes * values.itemsize)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets of the rows) of what _binary wrote."""
    column = pa.concat_arrays([column.cast(pa.large_binary())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None else np.zeros(0, kind)
    return values, (offsets - offsets[0]) // np.dtype(kind).itemsize


def _square(i, j):
    """The number of a square of the matrix of nodes: block i of rows, block j >= i of columns."""
    return j * (j + 1) // 2 + i


def _parts(side: int, most: int = 1 << 17):
    """Sets of nodes and their documents to every square that they touch, as the places within its rows and its columns."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k, o = _values(batch.column(0), np.uint32)
            docs = batch.column(1).to_numpy()
            cuts = np.unique(np.append(np.searchsorted(o[1:], np.arange(most, o[-1], most)), len(docs)))
            for s, e in zip([0, *cuts], cuts):
                if s == e:
                    continue
                block = (k[o[s] : o[e]] // side).astype(np.int64)
                row = np.repeat(np.arange(s, e), np.diff(o[s : e + 1]))
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
                first = np.flatnonzero(new)
                row, block = row[first], block[first]
                parts = _binary((k[o[s] : o[e]] % side).astype(np.uint16), np.diff(np.append(first, o[e] - o[s])))
                n = np.searchsorted(row, row, "right") - np.arange(len(row))  # this part and those after it
                left = np.repeat(np.arange(len(row)), n)
                right = left + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                for x in range(0, len(left), 1 << 12):
                    u, v = left[x : x + (1 << 12)], right[x : x + (1 << 12)]
                    at = pa.array(_square(block[u], block[v]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([at, pa.array(docs[row[u]]), parts.take(pa.array(u)), parts.take(pa.array(v))], names=["square", "docs", "a", "b"])

    return run


def _cells(n: np.ndarray, total: int, shift: float, side: int, band: int, most: int = 1 << 18):
    """The edges of a task's square, from the documents of every pair of its nodes: a band of rows at a time, as the bits of
    the cells that hold an edge and its documents there. n: the documents of each node."""

    def run(batches):
        square, cells = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy()
            if cells is None:
                square, cells = int(at[0]), np.zeros((side, side), np.uint32)
            if (at != square).any():
                raise RuntimeError("a task has one square")
            flat, docs = cells.reshape(-1), batch.column(1).to_numpy().astype(np.uint32)
            (a, p), (b, q) = _values(batch.column(2), np.uint16), _values(batch.column(3), np.uint16)
            a, b, na, nb = a.astype(np.int64), b.astype(np.int64), np.diff(p), np.diff(q)
            large = na * nb >= 1024
            for r in np.flatnonzero(large):
                rows, cols, m = a[p[r] : p[r + 1]], b[q[r] : q[r + 1]], docs[r]
                if len(cols) < side >> 4:
                    step = max(1, most // len(cols))
                    for x in range(0, len(rows), step):
                        flat[(rows[x : x + step] * side)[:, None] + cols] += m
                else:
                    line = np.zeros(side, np.uint32)
                    line[cols] = m
                    for x in rows:
                        cells[x] += line
            few = np.flatnonzero(~large)
            upto = np.cumsum(na[few] * nb[few])
            cuts = np.unique(np.append(np.searchsorted(upto, np.arange(most, upto[-1], most)), len(few))) if len(few) else []
            for s, e in zip([0, *cuts], cuts):
                some = few[s:e]
                left = np.repeat(p[some], na[some]) + np.arange(na[some].sum()) - np.repeat(np.cumsum(na[some]) - na[some], na[some])
                r = np.repeat(some, na[some])
                right = np.repeat(q[r], nb[r]) + np.arange(nb[r].sum()) - np.repeat(np.cumsum(nb[r]) - nb[r], nb[r])
                np.add.at(flat, np.repeat(a[left], nb[r]) * side + b[right], np.repeat(docs[r], nb[r]))
        if cells is None:
            return
        j = (math.isqrt(8 * square + 1) - 1) // 2
        i = square - j * (j + 1) // 2
        mine, other = (n[x * side : (x + 1) * side].astype(float) for x in (i, j))
        for x in range(0, len(mine), band):
            held = cells[x : x + band, : len(other)][: len(mine) - x]
            edge = held * float(total) > shift * mine[x : x + band, None] * other
            if i == j:
                edge &= np.arange(len(other)) > np.arange(x, x + len(edge))[:, None]
            if edge.any():
                counts = held[edge]
                bits, low, more = np.packbits(edge), np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255]
                numbers = (i * side + x, j * side, len(bits), len(low))
                packed = (pa.compress(bits.tobytes(), "zstd", asbytes=True), pa.compress(low.tobytes(), "zstd", asbytes=True), more.tobytes())
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in numbers), *(pa.array([v]) for v in packed)], names=EDGES)

    return run


def _times(n: np.ndarray, total: int, shift: float, side: int, vectors: np.ndarray):
    """Partial products of the symmetric matrix of edges and vectors (a row each)."""

    def run(batches):
        out = np.zeros(vectors.shape)
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, size, held, bits, counts, more = (c[row].as_py() for c in batch.columns)
                width = min(side, len(n) - b)
                k = np.flatnonzero(np.unpackbits(np.frombuffer(pa.decompress(bits, size, "zstd", asbytes=True), np.uint8)))
                left, right = k // width, k % width
                c = np.frombuffer(pa.decompress(counts, held, "zstd", asbytes=True), np.uint8).astype(float)
                c[c == 255] = np.frombuffer(more, np.uint32)
                w = np.log(c * float(total) / (shift * n[a + left] * n[b + right]))
                for v, o in zip(vectors, out):
                    one = np.bincount(left, w * v[b + right])
                    o[a : a + len(one)] += one
                    one = np.bincount(right, w * v[a + left])
                    o[b : b + len(one)] += one
        some = np.flatnonzero(out.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(o[some]) for o in out)], names=["k", *(f"v{i}" for i in range(len(out)))])

    return run


def _scores(texts: pa.Array, found: _Set, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    if not len(found.values):
        return out
    for a, b in tv.chunks(texts):
        rows, matrix = _terms(texts.slice(a, b - a))
        at, k = found.find(matrix.ravel())
        word, w = at // matrix.shape[1], weights[k]
        best = np.zeros(len(rows))
        np.maximum.at(best, word, w)
        some = np.unique(word)
        order = np.lexsort((matrix[some, 0], rows[some]))
        some = some[order]
        new = np.ones(len(some), bool)
        new[1:] = (rows[some][1:] != rows[some][:-1]) | (matrix[some, 0][1:] != matrix[some, 0][:-1])
        np.add.at(out, a + rows[some[new]], best[some[new]])
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Four MinHash values of each document's word 3-grams; a shorter document has keys of its own."""
    mult = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
    for batch in batches:
        for a, b in tv.chunks(batch.column(1)):
            h, o = tv.words(batch.column(1).slice(a, b - a))
            g, at = tv.grams(h, o, 3)
            cut = np.searchsorted(at, o)
            some = np.flatnonzero(np.diff(cut) > 0)
            ids = batch.column(0).slice(a, b - a).to_numpy()
            out = tv.mix(ids.astype(np.int64).view(np.uint64)[:, None] * mult)
            for j in range(4):
                if len(some):
                    out[some, j] = np.minimum.reduceat(tv.mix(g * mult[j]), cut[some])
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(out[:, j].view(np.int64)) for j in range(4))], names=["i", "k0", "k1", "k2", "k3"])


def label_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(text, toxic, part 0, 1 or 2) of at most about max_labelled labelled documents, chosen by hash; of near copies the first stays."""
    known = labels.select(F.col("doc_id").cast("long").alias("i"), F.col("toxic").cast("int").alias("x")).where("i IS NOT NULL AND x IS NOT NULL")
    known = known.groupBy("i").agg(F.max("x").alias("x"))
    step = max(1, -(-known.count() // max_labelled))
    known = F.broadcast(known.where(F.pmod(F.xxhash64("i"), F.lit(step)) == 0))  # max_labelled rows at the most
    held = stash(docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t")).join(known, "i").dropDuplicates(["i"]), "labelled")
    keys = held.select("i", "t").mapInArrow(_keys, "i long, k0 long, k1 long, k2 long, k3 long")
    keys = keys.select("i", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("j", "k"))
    first = F.min("i").over(Window.partitionBy("j", "k"))
    own = keys.withColumn("f", first).groupBy("i").agg(F.min((F.col("f") == F.col("i")).cast("int")).alias("own")).where("own = 1").select("i")
    return held.join(F.broadcast(own), "i").select("t", "x", F.pmod(F.xxhash64("i", F.lit(3)), F.lit(3)).alias("part"))


def _evidence(n, share, against):
    """n times the divergence of a share from another: the log odds by which counts speak against the other, as a column."""
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    return n * (part(share, against) + part(1 - share, 1 - against))


def induce(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, support: int = 4, shift: float = 2.0, steps: int = 6, restart: float = 0.3):
    """(terms as int64 hashes, their polarities, threshold)."""
    spark, none = docs.sparkSession, (np.zeros(0, np.int64), np.zeros(0), float("inf"))
    sample = stash(label_sample(docs, labels, max_labelled), "labelled")
    seeding = sample.where("part > 0")  # the seeds say nothing unbiased about the documents that chose them
    n_all, n_toxic = seeding.agg(F.count("*"), F.coalesce(F.sum("x"), F.lit(0))).first()
    if not n_toxic:
        return none
    terms = seeding.select("t", "x").mapInArrow(_label_counts, "term long, toxic long, n long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    terms = stash(terms.where(F.col("n") >= support), "terms")
    tested = terms.count()
    share, base = F.col("toxic") / F.col("n"), F.lit(n_toxic / n_all)
    sure = _evidence(F.col("n"), share, base) >= math.log(max(2, tested))
    labelled = {r.term: r.share for r in terms.where((F.col("toxic") >= support) & (share >= 0.8) & sure).select("term", share.alias("share")).collect()}
    drop_stash(terms)
    up = np.array(list(labelled), np.int64)
    if not len(up):
        return none

    texts = docs.select(F.col("text").alias("t"))
    counts = stash(texts.mapInArrow(_counts(up), "term long, n long, both long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("both").alias("both")), "counts")
    total, marked = counts.where("term IS NULL").select("n", "both").first()
    if not marked:
        return none
    met = counts.where(F.col("term").isNotNull() & (F.col("both") >= support))
    drawn = (F.col("both") * float(total) > shift * F.col("n") * float(marked)) & (_evidence(F.col("n"), F.col("both") / F.col("n"), F.lit(marked / total)) >= math.log(max(2, met.count())))
    seeds = F.broadcast(spark.createDataFrame([(int(t), 1.0 / len(up)) for t in up], "term long, p0 double"))  # bounded by max_labelled
    nodes = met.join(seeds, "term", "left").where(drawn | F.col("p0").isNotNull()).select("term", "n", "both", F.coalesce("p0", F.lit(0.0)).alias("p0")).toPandas()
    drop_stash(counts)
    nodes = nodes.iloc[np.argsort(nodes["term"].to_numpy().view(np.uint64))]  # the order of _Set(ids).values
    ids, n, both, p0 = (nodes[c].to_numpy() for c in nodes.columns)

    blocks = max(1, -(-len(ids) // SIDE))
    side, squares = max(1, -(-len(ids) // blocks)), blocks * (blocks + 1) // 2
    sets = texts.mapInArrow(_sets(ids), "k binary").groupBy("k").agg(F.count("*").alias("docs"))
    parts = sets.mapInArrow(_parts(side), "square int, docs long, a binary, b binary").repartitionById(squares, "square")
    edges = stash(parts.mapInArrow(_cells(n, total, shift, side, BAND), "a int, b int, size int, held int, bits binary, counts binary, more binary"), "edges")

    def times(*vectors):
        vectors = np.array(vectors)
        names = [f"v{i}" for i in range(len(vectors))]
        got = edges.mapInArrow(_times(n, total, shift, side, vectors), ", ".join(["k long", *(f"{v} double" for v in names)]))
        got = got.groupBy("k").agg(*(F.sum(v).alias(v) for v in names)).toPandas()
        out = np.zeros(vectors.shape)
        out[:, got["k"].to_numpy()] = got[names].to_numpy().T
        return out

    weight = times(np.ones(len(ids)))[0]
    leave = np.divide(both / n, weight, out=np.zeros(len(ids)), where=weight > 0)
    q0 = (n - both) / n.sum()
    p, q = p0, q0
    for _ in range(steps):
        mp, mq = times(p * leave, q * leave)
        p, q = restart * p0 + (1 - restart) * mp, q0 + (1 - restart) * mq
    drop_stash(edges)
    w = np.divide(2 * p, p + q, out=np.zeros(len(ids)), where=p + q > 0) - 1
    polar = dict(zip(ids[w > 0].tolist(), w[w > 0].tolist()))
    polar |= {t: max(polar.get(t, 0.0), w) for t, w in labelled.items()}
    terms_ = np.array(sorted(polar), np.int64)
    weights = np.array([polar[t] for t in terms_.tolist()])

    lexicon = spark.sparkContext.broadcast((terms_, weights))

    def scored(batches):
        found, w = _Set(lexicon.value[0]), _aligned(*lexicon.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_scores(batch.column(0), found, w)), batch.column(1)], names=["s", "x"])

    held = sample.where("part = 0").select("t", "x")
    if held.where("x > 0").isEmpty():
        held = sample.select("t", "x")
    got = held.mapInArrow(scored, "s double, x int").collect()  # max_labelled rows at the most
    s, x = np.array([r.s for r in got]), np.array([r.x for r in got])
    order = np.argsort(-s, kind="stable")
    s, x = s[order], x[order]
    hits = np.cumsum(x > 0)
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + hits[-1])
    f1[:-1][s[1:] == s[:-1]] = -1  # a threshold can't part equal scores
    f1[s <= 0] = -1
    best = int(np.argmax(f1))
    below = s[best + 1] if best + 1 < len(s) else 0.0
    drop_stash(sample)
    return terms_, weights, float((s[best] + max(below, 0.0)) / 2) if f1[best] > 0 else float("inf")


def _aligned(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """weights in the order of _Set(terms).values."""
    return weights[np.argsort(terms.view(np.uint64))]


def toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, toxicity, toxic) for every row of docs."""
    terms, weights, threshold = induce(docs, labels, **how)
    lexicon = docs.sparkSession.sparkContext.broadcast((terms, weights))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        found, w = _Set(lexicon.value[0]), _aligned(*lexicon.value)
        for batch in batches:
            s = _scores(batch.column(1), found, w)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(s, 6)), pa.array(s >= threshold)], names=["doc_id", "toxicity", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, toxicity double, toxic boolean")
