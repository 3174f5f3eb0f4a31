"""Byte-pair encoding and decoding by dynamic programming over prefixes.

Every prefix of a pre-token has exactly one last token in its encoding. An automaton over the vocabulary yields the
tokens that are suffixes of each prefix; such a token t, starting at i, is the last token iff t and the last token of
the prefix of length i encode to just those two when put together (the compatibility test undoes merges along
the border of the pair until a lower-ranked merge across it shows up, or none can). The last tokens are stored
and followed back from the end, which gives the ids that merging by rank gives.

Pre-tokens met before are looked up in tables that are emptied when their entries come to CACHE_BYTES; an entry over
a 64th of that is never kept. The bound changes speed only.

The vocabulary is a tiktoken rank file whose path is a parameter; the driver reads it once and broadcasts its
compact tables (about the size of the file, whatever the corpus).

Defined cases
* A null text gives null ids, null n_tokens and null round_trip; an empty text gives no ids.
* Texts of any length are encoded whole; rows are encoded one by one, so repeated rows repeat their result.
* Ids out of the vocabulary decode to nothing; bytes that are not valid UTF-8 decode with replacement characters.
* Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
CACHE_BYTES = 64 << 20
CACHE_PAIRS = 200_000


def read_ranks(path: str = VOCABULARY) -> list[bytes]:
    """Token bytes by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def merge_tables(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two parts each token is merged from; a single byte is its own parts, a token that merging can't reach has -1."""
    ids = {t: i for i, t in enumerate(tokens) if t}
    left, right = np.full(len(tokens), -1, np.int64), np.full(len(tokens), -1, np.int64)
    for i, token in enumerate(tokens):
        if len(token) == 1:
            left[i] = right[i] = i
            continue
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            ranks = [ids.get(parts[k] + parts[k + 1], i) for k in range(len(parts) - 1)]
            best = min(ranks)
            if best >= i:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) == 2:
            left[i], right[i] = ids[parts[0]], ids[parts[1]]
    return left, right


class Bpe:
    """Encoder and decoder of one vocabulary; pre-tokens it has met are kept in a bounded table."""

    def __init__(self, tokens: list[bytes], left: np.ndarray, right: np.ndarray):
        import ahocorasick
        import regex

        self.tokens = tokens
        self.left, self.right = left.tolist(), right.tolist()
        self.merged = {(a, b): i for i, (a, b) in enumerate(zip(self.left, self.right)) if a >= 0 and len(tokens[i]) > 1}
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            if token and self.left[i] >= 0:
                self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.held = 0
        self.split = regex.compile(PATTERN).findall
        self.blanks = re.compile(r"^ | $|\s[ ]|[ ]\s").search
        self.whole = {token: np.int32(i).tobytes() for i, token in enumerate(tokens) if token and self.left[i] >= 0}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the tokens a, b put together encode to a, b again."""
        left, right, merged, limit = self.left, self.right, self.merged, 1 << 40
        while True:
            if merged.get((a, b), limit) < limit:
                return False
            if a > b:
                limit = a
                a = right[a]
                if a == limit:
                    limit = b + 1
                    b = left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = left[b]
                if b + 1 == limit:
                    limit = a
                    a = right[a]
                    if a == limit:
                        return True

    def last_tokens(self, word: bytes) -> list[int]:
        """The last token of the encoding of every prefix; entry 0 is none."""
        last = [-1] * (len(word) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(word.decode("latin-1")):
            end += 1
            if last[end] < 0:
                if size == end:
                    last[end] = token
                    continue
                pair = last[end - size] << 32 | token
                ok = pairs.get(pair)
                if ok is None:
                    if len(pairs) > CACHE_PAIRS:
                        pairs.clear()
                    ok = pairs[pair] = self.compatible(last[end - size], token)
                if ok:
                    last[end] = token
        return last

    def encode_word(self, word: bytes) -> list[int]:
        last, at, out = self.last_tokens(word), len(word), []
        while at:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def _piece(self, piece: str) -> bytes:
        """The ids of one pre-token."""
        raw = piece.encode()
        ids = self.whole.get(raw)
        if ids is None:
            ids = self.bare.get(piece)
            if ids is None:
                ids = np.array(self.encode_word(raw), np.int32).tobytes()
                self._keep(self.bare, piece, ids)
        return ids

    def _keep(self, table: dict[str, bytes], key: str, ids: bytes) -> None:
        """Remembers the ids of a piece, unless it is very long."""
        size = key.__sizeof__() + len(ids) + 130
        if size <= CACHE_BYTES >> 6:
            table[key] = ids
            self.held += size

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a space and a run of text without spaces."""
        pieces = self.split(" " + chunk)
        ids = self._piece(pieces[0]) if len(pieces) == 1 else b"".join([self.words.get(p[1:]) or self._piece(p) if p[0] == " " else self._piece(p) for p in pieces])
        self._keep(self.words, chunk, ids)
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit integers.

        A space between two characters that aren't white space always begins a pre-token, so there the text can be cut
        and the runs between spaces looked up; other texts are split by the pattern alone.
        """
        if self.held > CACHE_BYTES:
            self.words.clear()
            self.bare.clear()
            self.held = 0
        if self.blanks(text):
            return b"".join([self._piece(p) for p in self.split(text)])
        words = self.words
        first, *chunks = text.split(" ")
        head = b"".join([self._piece(p) for p in self.split(first)])
        try:
            return head + b"".join([words[c] for c in chunks])
        except KeyError:
            return head + b"".join([words.get(c) or self._chunk(c) for c in chunks])

    def decode_bytes(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        try:
            return b"".join([tokens[i] for i in ids])
        except (IndexError, TypeError):
            return b"".join(tokens[i] for i in ids if i is not None and 0 <= i < len(tokens))


_made: dict[bytes, Bpe] = {}


def _tables(df: DataFrame, vocabulary: str):
    tokens = read_ranks(vocabulary)
    left, right = merge_tables(tokens)
    digest = hashlib.sha256(b"".join(b"%d:%b" % (len(t), t) for t in tokens)).digest()
    return df.sparkSession.sparkContext.broadcast((digest, tokens, left.astype(np.int32), right.astype(np.int32)))


def _bpe(tables) -> Bpe:
    """One per worker process and vocabulary."""
    key = tables.value[0]
    if key not in _made:
        _made.clear()
        _made[key] = Bpe(*tables.value[1:])
    return _made[key]


def bpe_encode(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), check: bool = True) -> DataFrame:
    """keep's columns, n_tokens, token_ids and, if check, whether decoding the ids gives the text again."""
    tables = _tables(docs, vocabulary)
    fields = [docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    if check:
        fields.append(T.StructField("round_trip", T.BooleanType()))
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tables)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                packed, same, sizes, null = [], [], [], []
                for text in batch.column(kept).to_pylist():
                    null.append(text is None)
                    if text is None:
                        sizes.append(0)
                        same.append(None)
                        continue
                    ids = bpe.encode_bytes(text)
                    packed.append(ids)
                    sizes.append(len(ids) // 4)
                    if check:
                        same.append(bpe.decode_bytes(np.frombuffer(ids, np.int32).tolist()) == text.encode())
                offsets = np.zeros(len(sizes) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                mask = pa.array(null)
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)
                columns = [batch.column(i) for i in range(kept)] + [pa.array(sizes, pa.int64(), mask=np.array(null)), lists]
                if check:
                    columns.append(pa.array(same, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    source = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))
    return source.mapInArrow(run, T.StructType(fields))


def bpe_decode(encoded: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep's columns and the text that token_ids decode to."""
    tables = _tables(encoded, vocabulary)
    fields = [encoded.schema[c] for c in keep] + [T.StructField("text", T.StringType())]
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tables)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [None if ids is None else bpe.decode_bytes(ids).decode("utf-8", "replace") for ids in batch.column(kept).to_pylist()]
                columns = [batch.column(i) for i in range(kept)] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    source = encoded.select(*[F.col(c) for c in keep], F.col("token_ids").alias("__ids"))
    return source.mapInArrow(run, T.StructType(fields))
