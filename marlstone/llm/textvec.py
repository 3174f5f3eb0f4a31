"""Word hashes of whole Arrow columns of text by NumPy, without a Python object for any word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MASK = (1 << 64) - 1
P = 0x9E3779B97F4A7C15 | 1
P_INV = pow(P, -1, 1 << 64)
CHUNK = 1 << 21
BLOCK = 1 << 20

_table = np.random.Generator(np.random.PCG64(20240607)).integers(1, MASK, 256, dtype=np.uint64)
_word = np.zeros(256, bool)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _word[_c] = True
_word[128:] = True
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, P, np.uint64)
        steps[0] = 1
        back = np.full(size, P_INV, np.uint64)
        back[0] = 1
        _pow, _inv = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, size: int = CHUNK):
    """(first, last) row ranges of about size bytes of text; a longer row is a range of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield at, i
            at, total = i, 0
        total += int(n)
    if at < len(lengths):
        yield at, len(lengths)


def _spaced(low: pa.Array) -> pa.Array:
    """Text with a space for every separator, mark and sign beyond ASCII, and around every character of a script that is
    written without spaces."""
    data = np.frombuffer(low.buffers()[2], np.uint8) if low.buffers()[2] is not None else np.zeros(0, np.uint8)
    heads = np.bincount(data, minlength=256) if len(data) < BLOCK else sum(np.bincount(data[i : i + BLOCK], minlength=256) for i in range(0, len(data), BLOCK))
    if heads[0xC2] or heads[0xE0:0xF8].any():
        low = pc.replace_substring_regex(low, r"[\p{Z}\p{P}\p{S}\p{Cc}]", " ")
    if heads[0xE0:0xF8].any():
        low = pc.replace_substring_regex(low, r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ")
    return low


def _cuts(inside: np.ndarray) -> list[int]:
    """Ends of blocks of about BLOCK bytes that part no word; a longer word lies in a block that is longer."""
    n, out, at = len(inside), [], 0
    while n - at > BLOCK:
        gaps = np.flatnonzero(~inside[at + 1 : at + BLOCK])
        if len(gaps):
            at += 1 + int(gaps[-1])
        else:
            step = at + BLOCK
            while step < n and not len(gaps := np.flatnonzero(~inside[step : step + BLOCK])):
                step += BLOCK
            at = step + int(gaps[0]) if step < n else n
        out.append(at)
    return [*out, n] if not out or out[-1] < n else out


def words(texts: pa.Array, prefixes: tuple[int, ...] = ()):
    """(hash of every word in order, offsets of the rows' words, and if prefixes are given a matrix of the hashes of the
    words' first so many bytes, 0 where the word has no more). A word is a maximal run, in lower case, of ASCII letters
    and digits and of characters beyond ASCII that are no separator, mark or sign; each character of a script without
    spaces (Han, Kana, Thai, Lao, Khmer, Burmese) is a word. A null text has none. Only about BLOCK bytes of text are
    spread into numbers at a time, however long a text is."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    low = pa.concat_arrays([_spaced(pa.concat_arrays([low]))])
    offsets = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    n = last - first
    if n == 0:
        none = np.zeros(0, np.uint64), np.zeros(len(low) + 1, np.int64)
        return (*none, np.zeros((0, len(prefixes)), np.uint64)) if prefixes else none
    data = np.frombuffer(low.buffers()[2], np.uint8)[first:last]
    offsets = offsets - first
    inside = _word[data]
    # A row's end parts words as a space does.
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    ends[tails] = inside[tails]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    whole = np.empty(len(s), np.uint64)
    heads = np.zeros((len(s), len(prefixes)), np.uint64)
    cuts = _cuts(inside)
    at = 0
    for a, b in zip([0, *cuts], cuts):
        stop = int(np.searchsorted(s, b))
        if stop == at:
            continue
        x, y = s[at:stop] - a, e[at:stop] - a
        short = np.flatnonzero(y - x <= BLOCK)
        for i in np.flatnonzero(y - x > BLOCK):
            whole[at + i] = xxhash.xxh64_intdigest(data[a + x[i] : a + y[i]].tobytes())
            for j, k in enumerate(prefixes):
                heads[at + i, j] = mix((_table[data[a + x[i] : a + x[i] + k]] * _powers(k)[0][:k]).sum(keepdims=True) + np.uint64(k))[0]
        if len(short):
            up, down = _powers(b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(_table[data[a:b]] * up[: b - a], out=sums[1:])
            x, y = x[short], y[short]
            whole[at + short] = mix((sums[y] - sums[x]) * down[x])
            for j, k in enumerate(prefixes):
                longer = np.flatnonzero(y - x > k)
                z = x[longer]
                heads[at + short[longer], j] = mix((sums[z + k] - sums[z]) * down[z] + np.uint64(k))
        at = stop
    starts = np.searchsorted(s, offsets).astype(np.int64)
    return (whole, starts, heads) if prefixes else (whole, starts)


def grams(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every n-gram of words within a row, the index of its first word)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out *= np.uint64(P)
        out += hashes[j : j + m]
    ok = np.ones(m, bool)
    for j in range(1, n):
        cut = offsets[1:-1] - j
        ok[cut[(cut >= 0) & (cut < m)]] = False
    at = np.flatnonzero(ok)
    return mix(out[at]), at
