"""N-gram Jaccard self-join by chosen paths.

Every document is the set of its word n-grams. A run splits the sets recursively: a set is embedded as T MinHash tokens,
and follows, from each node it is in, the tokens that a seeded hash of (node, token) samples with probability
1 / (lambda T); sets that sample the same tokens share a node. Similar sets share many tokens and so go down together;
others part. A node goes on being split until it has at most `bucket` sets, or until no token parts it: it holds
a share of its parent's sets that reaches the threshold, as it does where they are that similar on average, so that most
pairs are links. Such a node is a leaf, and its sets are compared by brute force. Runs are repeated
until a pair at the threshold is met, `levels` levels down, with the target recall. Pairs whose sketches come near the
threshold are verified exactly on the whole sets.

What leaves a leaf grows with its sets, not with its pairs: each set's number of links, and a spanning forest of the
links. So that a pair which several leaves hold counts once, sets carry the list of their leaves, and a pair is
left to the first leaf that both are in. Leaves are compared in blocks by many tasks (by rows for sketches, by
bytes for whole sets); no node, set or number of partners is cut off. Node sizes are counted by partial sums and
joined back, where adaptive execution splits the rows of a hot node.

Defined cases
* The result has one row for each document with a link: class_id, the lowest doc_id that links connect it with, and
  links, the number of other documents at the threshold or above. Documents without a link have no row.
* Equal sets are compared once and counted as often as documents have them, at Jaccard 1.
* A document is a pair of doc_id and text: rows equal in both are one document, and give one row; rows that share a
  doc_id and differ in text are documents of their own, whose links count apart.
* Documents with fewer words than n are one n-gram, the whole of it; documents without words (null, empty or
  only punctuation) and rows with a null doc_id match nothing. See textvec.words for what a word is.
* doc_id may be of any type that can be ordered. Texts of any length count whole. Extra columns are ignored. An empty
  table gives an empty result. Set ids are 64-bit hashes of 128-bit ones: n different sets confuse two with
  probability n^2 / 2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import broadcast_if_small, drop_stash, stash

T = 64
BLOCK = 4096
BLOCK_BYTES = 16 << 20
_rng = np.random.Generator(np.random.PCG64(7))
_MULT = _rng.integers(1, tv.MASK, T, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, tv.MASK, T, dtype=np.uint64)
_SALT = np.uint64(0xA24BAED4963EE407)


def runs_for(recall: float, levels: int) -> int:
    """Runs after which a pair at the threshold has met with that probability, all the way down to the last level."""
    p = 1.0
    for _ in range(levels):
        p = 1 - math.exp(-p)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of each row in turn, row offsets)."""
    h, o = tv.words(texts)
    g, at = tv.grams(h, o, n)
    short = np.flatnonzero((np.diff(o) < n) & (np.diff(o) > 0))
    rows = np.searchsorted(o, at, side="right") - 1
    if len(short):
        extra = np.array([tv.mix(np.bitwise_xor.reduce(tv.mix(h[o[i] : o[i + 1]] + np.arange(1, o[i + 1] - o[i] + 1, dtype=np.uint64)), keepdims=True))[0] for i in short], np.uint64)
        g, rows = np.concatenate([g, extra]), np.concatenate([rows, short])
    order = np.lexsort((g, rows))
    g, rows = g[order], rows[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (rows[1:] != rows[:-1])
    g, rows = g[new], rows[new]
    return g, np.searchsorted(rows, np.arange(len(texts) + 1))


def sketches(g: np.ndarray, o: np.ndarray) -> np.ndarray:
    """The T MinHash values (upper 32 bits) of each non-empty set; o has the offsets of those only."""
    out = np.empty((len(o) - 1, T), np.uint32)
    for k in range(T):
        x = g * _MULT[k]
        x += _ADD[k]
        out[:, k] = np.minimum.reduceat(x, o[:-1]) >> np.uint64(32)
    return out


def _features(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in tv.chunks(texts):
                g, o = gram_sets(texts.slice(a, b - a), n)
                some = np.flatnonzero(np.diff(o) > 0)
                if not len(some):
                    continue
                starts = np.append(o[some], len(g))
                sig = sketches(g, starts)
                f1 = np.add.reduceat(tv.mix(g), starts[:-1])
                f2 = np.bitwise_xor.reduceat(tv.mix(g + _SALT), starts[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(some)),
                        batch.column(1).slice(a, b - a).take(pa.array(some)),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.array([x.tobytes() for x in sig], pa.binary()),
                    ],
                    names=["k", "d", "f1", "f2", "sig"],
                )

    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, T)


def _tokens(sig: np.ndarray) -> np.ndarray:
    return tv.mix(sig.astype(np.uint64) + (np.arange(1, T + 1, dtype=np.uint64) << np.uint64(33)))


def _limit(lam: float) -> np.uint64:
    return np.uint64(min(tv.MASK, int(2**64 / (lam * T))))


def _first_level(runs: int, lam: float):
    seeds = tv.mix(np.arange(1, runs + 1, dtype=np.uint64) * _SALT)
    limit = _limit(lam)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                if not part.num_rows:
                    continue
                tokens = _tokens(_signatures(part.column(1)))
                d = part.column(0).to_numpy()
                for seed in seeds:
                    node = tv.mix(tokens ^ seed)
                    row, col = np.nonzero(tv.mix(node + _SALT) < limit)
                    yield pa.RecordBatch.from_arrays([pa.array(node[row, col].view(np.int64)), pa.array(d[row]), pa.array(np.zeros(len(row), np.int64))], names=["node", "s", "above"])

    return run


def _next_level(lam: float):
    limit = _limit(lam)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                if not part.num_rows:
                    continue
                parent, d, size = (part.column(i).to_numpy() for i in range(3))
                node = tv.mix(_tokens(_signatures(part.column(3))) ^ tv.mix(parent.view(np.uint64) + np.uint64(1))[:, None])
                row, col = np.nonzero(tv.mix(node + _SALT) < limit)
                yield pa.RecordBatch.from_arrays([pa.array(node[row, col].view(np.int64)), pa.array(d[row]), pa.array(size[row])], names=["node", "s", "above"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups: the rows come sorted by the first `keys` columns, and a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        end = tuple(c[-1] for c in cols)
        if last is not None and end == last:
            held.append(batch)
            continue
        tail = np.ones(batch.num_rows, bool)
        for c, e in zip(cols, end):
            tail &= c == e
        cut = int(np.argmax(tail))
        held.append(batch.slice(0, cut))
        whole = pa.Table.from_batches([b for b in held if b.num_rows]) if any(b.num_rows for b in held) else None
        if whole is not None:
            yield whole
        held, last = [batch.slice(cut)], end
    if held:
        yield pa.Table.from_batches(held)


def _met(starts: np.ndarray, ends: np.ndarray, node, x, y, part, sig: np.ndarray, leaves: pa.ListArray, least: int):
    """(i, j) index arrays of the pairs of rows, within groups [start, end), that are to be compared in their node: sketches
    agree in at least `least` places, the parts are those of the group's block, and no earlier leaf holds both."""
    offsets = leaves.offsets.to_numpy()
    count = np.diff(offsets)
    width = max(1, int(count.max()) if len(count) else 1)
    mine = np.full((len(node), width), np.iinfo(np.int64).max)
    mine[np.repeat(np.arange(len(node)), count), np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)] = leaves.values.to_numpy()[offsets[0] : offsets[-1]]
    end_of = np.repeat(ends, ends - starts)
    rows = np.arange(len(node))
    k = 1
    while len(rows := rows[rows + k < end_of[rows]]):
        for at in range(0, len(rows), 16384):
            i = rows[at : at + 16384]
            j = i + k
            hit = (sig[i] == sig[j]).sum(1) >= least
            hit &= (x[i] == y[i]) | (part[i] != part[j])
            i, j = i[hit], j[hit]
            if len(i) and len(own := _first_here(i, j, node, mine)):
                yield i[own], j[own]
        k += 1


def _first_here(i: np.ndarray, j: np.ndarray, node: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Which pairs share no leaf before the node that they are met in; mine has the leaves of each row in order. Similar sets
    share most of their leaves, so nearly all pairs that do are settled by the first leaf or two."""
    found = []
    for at in range(0, len(i), 8192):
        alive = np.arange(at, min(len(i), at + 8192))
        for t in range(mine.shape[1]):
            leaf = mine[i[alive], t]
            early = leaf < node[i[alive]]
            found.append(alive[~early])
            alive, leaf = alive[early], leaf[early]
            if len(alive):
                alive = alive[~(mine[j[alive]] == leaf[:, None]).any(1)]
            if not len(alive):
                break
        found.append(alive)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _bounds(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], len(keys[0]))


def _compare(least: int):
    """The sets of each node that a pair to be verified has."""

    def run(batches):
        for table in _groups(batches, 3):
            table = table.combine_chunks()
            node, x, y, s, part = (table.column(i).to_numpy() for i in range(5))
            sig = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(-1, T)
            wanted = np.zeros(len(node), bool)
            for i, j in _met(*_bounds(node, x, y), node, x, y, part, sig, table.column(6).chunk(0), least):
                wanted[i] = wanted[j] = True
            at = np.flatnonzero(wanted)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(s[at])], names=["node", "s"])

    return run


def _sets(n: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for a, b in tv.chunks(texts):
                g, o = gram_sets(texts.slice(a, b - a), n)
                raw = g.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([raw[8 * o[i] : 8 * o[i + 1]] for i in range(b - a)], pa.binary())], names=["s", "grams"])

    return run


def _verify(threshold: float, least: int):
    """(s, root, links): by set of each block, what it is joined with there and the documents that it is linked with."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        node, x, y, s, part, copies = (table.column(i).to_numpy() for i in range(6))
        sig = np.frombuffer(b"".join(table.column(6).to_pylist()), np.uint8).reshape(-1, T)
        found = list(_met(np.array([0]), np.array([len(s)]), node, x, y, part, sig, table.column(7).chunk(0), least))
        links, label = np.zeros(len(s), np.int64), np.arange(len(s))
        if found:
            i, j = (np.concatenate(z) for z in zip(*found))
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            sets = table.column(8).to_pylist()
            sizes = np.array([len(b) // 8 for b in sets])
            _, code = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
            offsets = np.append(0, np.cumsum(sizes))
            mark = np.zeros(int(code.max()) + 1, bool)
            for a, b in zip(*_bounds(i)):
                own, o = i[a], j[a:b]
                mine = code[offsets[own] : offsets[own + 1]]
                mark[mine] = True
                both = np.array([np.count_nonzero(mark[code[offsets[k] : offsets[k + 1]]]) for k in o])
                mark[mine] = False
                o = o[both >= threshold * (sizes[own] + sizes[o] - both) - 1e-12]
                if len(o):
                    links[own] += copies[o].sum()
                    links[o] += copies[own]
                    joined = np.unique(np.append(label[o], label[own]))
                    if len(joined) > 1:
                        label[np.isin(label, joined)] = joined[0]
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(s[at]), pa.array(s[label[at]]), pa.array(links[at])], names=["s", "root", "links"])

    def run(batches):
        for table in _groups(batches, 3):
            starts, ends = _bounds(*(table.column(i).to_numpy() for i in range(3)))
            for a, b in zip(starts, ends):
                if b - a > 1:
                    yield solve(table.slice(a, b - a).combine_chunks())

    return run


def _blocks(rows: DataFrame, parts) -> DataFrame:
    """rows once for every pair of parts (x <= y) of their node that they belong to."""
    placed = rows.withColumn("parts", parts.cast("int")).withColumn("part", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int"))
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return placed.withColumn("x", F.least("part", "o")).withColumn("y", F.greatest("part", "o")).drop("o", "parts")


def _sharing(rows: DataFrame, tag: str) -> DataFrame:
    """(node, s, above, c) of the rows whose node holds c > 1 sets."""
    held = stash(rows, tag)
    sizes = held.groupBy("node").agg(F.count("*").alias("c")).where("c > 1")
    out = stash(held.join(sizes, "node").select("node", "s", "above", "c"), f"{tag}-shared")
    drop_stash(held)
    return out


def _links(sets: DataFrame, texts: DataFrame, n: int, threshold: float, recall: float, levels: int, bucket: int, slack: float) -> DataFrame:
    """(s, root, links), a few rows a set: the links and a spanning forest of the pairs of different sets.

    sets: (s, sig, copies, k) with the key k of a row that has the set; texts: (k, t).
    """
    lone = sets.select("s", "sig")
    nodes = lone.mapInArrow(_first_level(runs_for(recall, levels), threshold), "node long, s long, above long")
    leaves, held, level = None, [], 1
    while True:
        nodes = _sharing(nodes, f"level{level}")
        held.append(nodes)
        small = F.col("c") <= bucket
        if level > 1:
            small = small | (F.col("c") >= threshold * F.col("above"))
        done = nodes.where(small).select("node", "s", "c")
        leaves = done if leaves is None else leaves.unionByName(done)
        open_ = nodes.where(~small)
        if open_.isEmpty():
            break
        nodes = open_.select("node", "s", "c").join(lone, "s").select("node", "s", "c", "sig").mapInArrow(_next_level(threshold), "node long, s long, above long")
        level += 1

    # A set is in as many leaves as its paths end in: a number that runs and levels bound, not the corpus.
    paths = leaves.groupBy("s").agg(F.sort_array(F.collect_list("node")).alias("leaves"))
    paths = stash(paths.join(sets.mapInArrow(_low_bytes, "s long, sig binary, copies long, k long"), "s"), "paths")
    least = math.ceil((threshold - slack) * T)
    placed = _blocks(leaves.join(paths.select("s", "sig", "leaves"), "s"), F.ceil(F.col("c") / BLOCK))
    placed = placed.select("node", "x", "y", "s", "part", "sig", "leaves").repartition("node", "x", "y").sortWithinPartitions("node", "x", "y")
    members = stash(placed.mapInArrow(_compare(least), "node long, s long").distinct(), "members")
    drop_stash(*held)

    needed = stash(members.select("s").distinct().join(paths.select("s", "k"), "s"), "needed")
    grams = texts.join(broadcast_if_small(needed), "k").select("s", "t").mapInArrow(_sets(n), "s long, grams binary")
    grams = stash(grams.groupBy("s").agg(F.first("grams").alias("grams")), "sets-of-members")
    drop_stash(needed)
    weight = members.join(grams.select("s", F.octet_length("grams").alias("z")), "s").groupBy("node").agg(F.sum("z").alias("z"))
    rows = members.join(weight, "node").join(paths.select("s", "copies", "sig", "leaves"), "s").join(grams, "s")
    rows = _blocks(rows, F.greatest(F.ceil(F.col("z") / BLOCK_BYTES), F.lit(1)))
    rows = rows.select("node", "x", "y", "s", "part", "copies", "sig", "leaves", "grams").repartition("node", "x", "y").sortWithinPartitions("node", "x", "y")
    out = stash(rows.mapInArrow(_verify(threshold, least), "s long, root long, links long"), "links")
    drop_stash(members, paths, grams)
    return out


def _classes(docs: DataFrame, n: int = 3, threshold: float = 0.5, recall: float = 0.97, levels: int = 8, bucket: int = 64, slack: float = 0.15) -> DataFrame:
    """(k, doc_id, class_id, class_k, links) of each document with a link; k is the key of doc_id and text."""
    base = docs.select(F.xxhash64("doc_id", "text").alias("k"), F.col("doc_id").alias("d"), F.col("text").alias("t")).where("d IS NOT NULL")
    kind = dict(base.dtypes)["d"]
    found = stash(base.mapInArrow(_features(n), f"k long, d {kind}, f1 long, f2 long, sig binary"), "grams")
    keys = ["f1", "f2"]
    known = found.groupBy(*keys, "k").agg(F.first("d").alias("d")).groupBy(*keys).agg(F.count("*").alias("copies"), F.min(F.struct("d", "k")).alias("low"))
    sets = found.groupBy(*keys).agg(F.first("sig").alias("sig")).join(known, keys)
    sets = stash(sets.select(F.xxhash64(*keys).alias("s"), "sig", "copies", F.col("low.k").alias("k"), F.col("low.d").alias("d")), "sets")
    held = _links(sets.select("s", "sig", "copies", "k"), base.select("k", "t"), n, threshold, recall, levels, bucket, slack)
    label = components(held.where("s <> root").select(F.col("root").alias("doc_a"), F.col("s").alias("doc_b"))).withColumnRenamed("d", "s")
    linked = held.groupBy("s").agg(F.sum("links").alias("links"))
    own = sets.select("s", "copies", "d", "k").join(linked, "s", "left").join(label, "s", "left")
    own = own.select("s", F.coalesce("root", "s").alias("root"), F.struct("d", "k").alias("low"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")).where("links > 0")
    own = stash(own, "own")
    lowest = own.groupBy("root").agg(F.min("low").alias("low"))
    named = stash(own.select("s", "root", "links").join(lowest, "root").select("s", "links", "low"), "classes")
    rows = found.select("k", "d", F.xxhash64(*keys).alias("s")).distinct()
    out = stash(rows.join(named, "s").select("k", F.col("d").alias("doc_id"), F.col("low.d").alias("class_id"), F.col("low.k").alias("class_k"), "links"), "linked")
    drop_stash(found, sets, held, own, named)
    return out


def ngram_jaccard_join(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, links) of each document that has another one at the threshold."""
    return _classes(docs, **how).select("doc_id", "class_id", "links")


def _low_bytes(batches):
    for batch in batches:
        if batch.num_rows:
            low = (_signatures(batch.column(1)) & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in low], pa.binary()), batch.column(2), batch.column(3)], names=["s", "sig", "copies", "k"])


def components(pairs: DataFrame) -> DataFrame:
    """(d, root): the lowest doc_id connected with each document that is in a pair, by repeated hooking and pointer jumping.

    A round lowers the label of each document, and of its old root, to the least label of a neighbour's root, and jumps
    once. Rounds go on until one changes nothing: then every label is its own root and equal along every edge.
    """
    edges = stash(pairs.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).unionByName(pairs.select(F.col("doc_b").alias("a"), F.col("doc_a").alias("b"))).distinct(), "edges")
    label = stash(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("d"), F.least("a", "m").alias("root")), "label")
    while True:
        tops = label.select("d", "root").join(label.select(F.col("d").alias("root"), F.col("root").alias("top")), "root")
        met = edges.join(tops.select(F.col("d").alias("b"), "top"), "b").groupBy("a").agg(F.min("top").alias("m"))
        found = met.join(tops.withColumnRenamed("d", "a"), "a")
        lower = F.array(F.struct(F.col("a").alias("d"), F.least("m", "top").alias("r"), F.col("root").alias("old")), F.struct(F.col("root").alias("d"), F.col("m").alias("r"), F.lit(None).cast("long").alias("old")))
        hooks = found.select(F.inline(lower))
        new = stash(hooks.groupBy("d").agg(F.min("r").alias("root"), F.max("old").alias("old")), "label")
        changed = not new.where("root <> old").isEmpty()
        drop_stash(label)
        label = new
        if not changed:
            break
    drop_stash(edges)
    return label.select("d", "root")


def drop_near_copies(docs: DataFrame, **how) -> DataFrame:
    """docs with only the lowest document (by doc_id, then text hash) of each class left; columns unchanged, repeated rows
    stay repeated."""
    losers = stash(_classes(docs, **how).where("k <> class_k").select(F.col("k").alias("loser")), "losers")
    rows = docs.select(F.struct("*").alias("r"))
    kept = rows.join(broadcast_if_small(losers), F.col("r.doc_id").isNotNull() & (F.xxhash64("r.doc_id", "r.text") == F.col("loser")), "left_anti")
    return kept.select(*[F.col("r")[c].alias(c) for c in docs.columns])
