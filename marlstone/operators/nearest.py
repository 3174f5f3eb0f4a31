"""The k best products of a set of queries with a corpus that streams by."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Queries of a tile, and rows of the corpus that meet it at once.
TILE, PIECE = 512, 8192


class Best:
    """The k best rows of each of m queries as rows come by, ties by id; what can't be among them any more is dropped."""

    def __init__(self, m: int, k: int):
        self.m, self.k, self.least, self.settled = m, k, np.full(m, -np.inf), False
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list[pa.Array] = []
        self.base = self.total = self.new = 0

    def begin(self, ids: pa.Array) -> None:
        """The ids of the rows that add() names from now on."""
        self.ids.append(ids)
        self.base, self.total = self.total, self.total + len(ids)

    def add(self, q: np.ndarray, scores: np.ndarray, rows: np.ndarray) -> None:
        if len(q):
            self.found.append((q.astype(np.int32), scores, (rows + self.base).astype(np.int32)))
            self.new += len(q)

    def settle(self) -> None:
        """Keeps the k best of each query; least is then the k-th score where there are k."""
        self.settled, self.new = True, 0
        if not self.found:
            self.ids, self.base, self.total = [], 0, 0
            return
        q, s, r = (np.concatenate(x) for x in zip(*self.found))
        self.found = []
        used = np.zeros(self.total, bool)
        used[r] = True
        ids = pa.concat_arrays(self.ids).take(pa.array(np.flatnonzero(used)))
        r = (np.cumsum(used, dtype=np.int32) - 1)[r]
        place = np.empty(len(ids), np.int32)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((place[r], -s, q))
        q, s, r = q[order], s[order], r[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        self.least[q[nth == self.k - 1]] = s[nth == self.k - 1]
        keep = nth < self.k
        self.found, self.ids, self.base, self.total = [(q[keep], s[keep], r[keep])], [ids], 0, len(ids)

    def full(self) -> bool:
        return self.new > max(1 << 17, self.m * self.k // 2)

    def rows(self, queries: pa.Array, names: list[str], size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        self.settle()
        for q, s, r in self.found:
            for i in range(0, len(q), size):
                part = slice(i, i + size)
                yield pa.RecordBatch.from_arrays([queries.take(pa.array(q[part])), self.ids[0].take(pa.array(r[part])), pa.array(s[part])], names=names)


def offer(best: Best, a: np.ndarray, b: np.ndarray, b32: np.ndarray, ids: pa.Array, positive: bool, apart: Callable | None = None, tail: Callable | None = None) -> None:
    """Offers best the rows a with ids for its queries b, both of doubles; b32 is b in single precision.

    Products in single precision, with a bound on their error, find what may reach a query's least score; only that is
    computed in double precision and rounded to 6 places. positive leaves out products of 0 and takes all factors as 0 or
    more. apart(queries, rows) marks pairs that don't count. tail(s, e) gives (cells, parts) that add to the products of
    the tile of queries s to e with the rows.
    """
    n = len(a)
    if not n or not best.m:
        return
    fresh = not best.settled and n > best.k
    a32 = a.astype(np.float32).T
    slack = (a.shape[1] + 64) * 2.0**-23
    longest = np.sqrt(np.einsum("ij,ij->i", a, a).max())
    best.begin(ids)
    for s in range(0, best.m, TILE):
        e = min(best.m, s + TILE)
        x = b32[s:e] @ a32
        flat = x.reshape(-1)
        if tail:
            cells, parts = tail(s, e)
            np.add.at(flat, cells, parts.astype(np.float32))
        least = best.least[s:e]
        if fresh:
            if apart:
                x[apart(np.arange(s, e)[:, None], np.arange(n)[None, :])] = -np.inf
            least = np.maximum(least, np.partition(x, n - best.k, axis=1)[:, n - best.k])
        scale = np.maximum(least, 0) if positive else longest * np.sqrt(np.einsum("ij,ij->i", b[s:e], b[s:e]))
        floor = least - (1 + fresh) * (slack * scale + 1e-6)
        hit = x >= (np.maximum(floor, 1e-30) if positive else floor).astype(np.float32)[:, None]
        at = np.flatnonzero(hit)
        rows, cols = np.divmod(at, n)
        exact = np.empty(len(at))
        for i in range(0, len(at), PIECE):
            exact[i : i + PIECE] = np.einsum("ij,ij->i", b[s + rows[i : i + PIECE]], a[cols[i : i + PIECE]])
        if tail:
            own = np.flatnonzero(hit.reshape(-1)[cells])
            np.add.at(exact, np.searchsorted(at, cells[own]), parts[own])
        ok = exact > 0 if positive else np.ones(len(at), bool)
        if apart:
            ok &= ~apart(s + rows, cols)
        exact = np.round(exact, 6) + 0.0
        ok &= exact >= best.least[s + rows]
        best.add(s + rows[ok], exact[ok], cols[ok])
        if best.settled and best.full():
            best.settle()
            best.begin(ids)
    if not best.settled or best.full():
        best.settle()


class Terms:
    """The weighted terms of m queries: the most used ones as columns of a dense matrix, the others as postings by tile."""

    def __init__(self, at: np.ndarray, tok: np.ndarray, idf: np.ndarray, m: int, head: int = 128):
        self.known, where = np.unique(tok, return_inverse=True)
        weight = np.zeros(len(self.known))
        weight[where] = idf
        load = np.bincount(where, minlength=len(self.known)) / np.maximum(np.expm1(weight), 1e-12)
        top = np.argsort(-load, kind="stable")[:head]
        self.column = np.full(len(self.known), -1)
        self.column[top] = np.arange(len(top))
        col = self.column[where]
        self.b = np.zeros((m, len(top)))
        self.b[at[col >= 0], col[col >= 0]] = idf[col >= 0]
        self.b32 = self.b.astype(np.float32)
        self.tiles = []
        rest = np.flatnonzero(col < 0)
        for s in range(0, m, TILE):
            own = rest[(at[rest] >= s) & (at[rest] < s + TILE)]
            own = own[np.argsort(where[own], kind="stable")]
            self.tiles.append((np.searchsorted(where[own], np.arange(len(self.known) + 1)).astype(np.int32), at[own] - s, idf[own]))

    def meet(self, best: Best, ids: pa.Array, at: np.ndarray, tok: np.ndarray, parts: np.ndarray) -> None:
        """Offers best the rows with ids; row at[i] has the term tok[i] with the weight parts[i]."""
        n = len(ids)
        if not len(self.known):
            return
        spot = np.searchsorted(self.known, tok)
        spot[spot == len(self.known)] = 0
        hit = np.flatnonzero(self.known[spot] == tok)
        at, spot, parts = at[hit], spot[hit], parts[hit]
        col = self.column[spot]
        a = np.zeros((n, self.b.shape[1]))
        a[at[col >= 0], col[col >= 0]] = parts[col >= 0]
        at, spot, parts = at[col < 0], spot[col < 0], parts[col < 0]

        def tail(s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
            start, q, idf = self.tiles[s // TILE]
            count = start[spot + 1] - start[spot]
            some = np.flatnonzero(count)
            count = count[some].astype(np.int64)
            own = np.repeat(some, count)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + start[spot[own]]
            return q[nth] * n + at[own], idf[nth] * parts[own]

        offer(best, a, self.b, self.b32, ids, True, tail=tail)
