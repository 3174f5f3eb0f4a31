"""Lossless WebP (VP8L): a decoder of the whole format and an encoder that exercises it.

decode reads the RIFF container, the prefix codes (simple and normal, grouped by an entropy image), literals,
back-references with the short-distance map, and the colour cache, then undoes the predictor, cross-colour,
subtract-green and palette transforms in reverse order. Pixels come out as an H x W x 4 array of R, G, B, A bytes.

encode writes valid streams with any of those features switched on; it serves the tests and makes image columns of
tables that have none.

Defined cases
* A null image decodes to nulls. Bytes that are no lossless WebP, are cut off or break a rule of the format decode to
  nulls with the reason in error; other rows aren't affected. So does an image of more than max_pixels pixels (a
  parameter, 2^24 if not given): a few bytes may stand for 2^28, which no task's memory holds.
* Equal images decode alike, whatever their number; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PIXELS = 1 << 24
CODE_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS, GREEN, PALETTE = range(4)


def _near() -> list[tuple[int, int]]:
    """(dx, dy) of the 120 short distance codes."""
    codes = (
        "0,1 1,0 1,1 -1,1 0,2 2,0 1,2 -1,2 2,1 -2,1 2,2 -2,2 0,3 3,0 1,3 -1,3 3,1 -3,1 2,3 -2,3 3,2 -3,2 0,4 4,0 1,4 -1,4 4,1 -4,1 3,3 -3,3 "
        "2,4 -2,4 4,2 -4,2 0,5 3,4 -3,4 4,3 -4,3 5,0 1,5 -1,5 5,1 -5,1 2,5 -2,5 5,2 -5,2 4,4 -4,4 3,5 -3,5 5,3 -5,3 0,6 6,0 1,6 -1,6 6,1 -6,1 "
        "2,6 -2,6 6,2 -6,2 4,5 -4,5 5,4 -5,4 3,6 -3,6 6,3 -6,3 0,7 7,0 1,7 -1,7 5,5 -5,5 7,1 -7,1 4,6 -4,6 6,4 -6,4 2,7 -2,7 7,2 -7,2 3,7 -3,7 "
        "7,3 -7,3 5,6 -5,6 6,5 -6,5 8,0 4,7 -4,7 7,4 -7,4 8,1 8,2 6,6 -6,6 8,3 5,7 -5,7 7,5 -7,5 8,4 6,7 -6,7 7,6 -7,6 8,5 7,7 -7,7 8,6 8,7"
    )
    return [tuple(map(int, c.split(","))) for c in codes.split()]


NEAR = _near()


class Bits:
    """Bits of a byte string, the lowest first, read past the end as an error."""

    def __init__(self, data: bytes):
        self.at, self.end = 0, 8 * len(data)
        self.data = data + b"\0" * 16

    def peek(self, n: int) -> int:
        return (int.from_bytes(self.data[self.at >> 3 : (self.at >> 3) + 4], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        if not n:
            return 0
        out = self.peek(n)
        self.at += n
        if self.at > self.end:
            raise ValueError("the data ends early")
        return out


def canonical(lengths: list[int]) -> dict[tuple[int, int], int]:
    """(length, code with its bits in stream order) -> symbol."""
    used = [(n, s) for s, n in enumerate(lengths) if n]
    if not used:
        raise ValueError("a prefix code without symbols")
    if len(used) == 1:
        return {(0, 0): used[0][1]}
    if sum(1 << (15 - n) for n, _ in used) != 1 << 15:
        raise ValueError("an incomplete or oversubscribed prefix code")
    code, last, out = 0, 0, {}
    for n, s in sorted(used):
        code <<= n - last
        out[n, int(format(code, f"0{n}b")[::-1], 2)] = s
        code, last = code + 1, n
    return out


class Prefix:
    """A decoder of one prefix code by a table over its longest length."""

    def __init__(self, lengths: list[int]):
        codes = canonical(lengths)
        self.width = max(n for n, _ in codes)
        self.table = [(0, 0)] * (1 << self.width)
        for (n, c), s in codes.items():
            for k in range(c, 1 << self.width, 1 << n):
                self.table[k] = (s, n)

    def read(self, bits: Bits) -> int:
        symbol, n = self.table[bits.peek(self.width)]
        bits.at += n
        if bits.at > bits.end:
            raise ValueError("the data ends early")
        return symbol


def read_code(bits: Bits, size: int) -> Prefix:
    lengths = [0] * size
    if bits.read(1):
        two = bits.read(1)
        for n in (8 if bits.read(1) else 1, *([8] if two else [])):
            s = bits.read(n)
            if s >= size:
                raise ValueError("a symbol out of its alphabet")
            lengths[s] = 1
        return Prefix(lengths)
    order = [0] * 19
    for i in range(4 + bits.read(4)):
        order[CODE_ORDER[i]] = bits.read(3)
    of_lengths = Prefix(order)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    if left > size:
        raise ValueError("more code lengths than symbols")
    at, last = 0, 8
    while at < size and left:
        left -= 1
        n = of_lengths.read(bits)
        if n < 16:
            lengths[at] = n
            last = n or last
            at += 1
            continue
        value, times = (last, 3 + bits.read(2)) if n == 16 else (0, 3 + bits.read(3)) if n == 17 else (0, 11 + bits.read(7))
        if at + times > size:
            raise ValueError("code lengths run over")
        lengths[at : at + times] = [value] * times
        at += times
    return Prefix(lengths)


def _value(bits: Bits, symbol: int) -> int:
    """A length or distance from its prefix symbol."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def _down(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


def read_pixels(bits: Bits, width: int, height: int, top: bool) -> array:
    """ARGB values of an entropy-coded image, row by row."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("a colour cache too large")
    cache = [0] * (1 << cache_bits) if cache_bits else []
    groups, tile, meta = 1, 0, None
    if top and bits.read(1):
        tile = bits.read(3) + 2
        meta = [(p >> 8) & 0xFFFF for p in read_pixels(bits, _down(width, tile), _down(height, tile), False)]
        groups = max(meta) + 1
    codes = [[read_code(bits, n) for n in (280 + len(cache), 256, 256, 256, 40)] for _ in range(groups)]
    tables = [[x for code in group[:4] for x in (code.table, (1 << code.width) - 1)] for group in codes]
    total, out, across = width * height, array("I"), _down(width, tile)
    shift = 32 - cache_bits
    data, end, pos, at = bits.data, bits.end, bits.at, 0
    green, green_mask, red, red_mask, blue, blue_mask, alpha, alpha_mask = tables[0]
    far = codes[0][4]
    while at < total:
        if meta:
            k = meta[(at // width >> tile) * across + (at % width >> tile)]
            green, green_mask, red, red_mask, blue, blue_mask, alpha, alpha_mask = tables[k]
            far = codes[k][4]
        # Four codes have 60 bits at the most: nine bytes hold them wherever they begin.
        word = int.from_bytes(data[pos >> 3 : (pos >> 3) + 9], "little") >> (pos & 7)
        s, n = green[word & green_mask]
        if s < 256:
            word >>= n
            r, m = red[word & red_mask]
            word >>= m
            n += m
            b, m = blue[word & blue_mask]
            word >>= m
            n += m
            a, m = alpha[word & alpha_mask]
            pos += n + m
            if pos > end:
                raise ValueError("the data ends early")
            pixel = a << 24 | r << 16 | s << 8 | b
            out.append(pixel)
            at += 1
            if cache_bits:
                cache[(0x1E35A7BD * pixel & 0xFFFFFFFF) >> shift] = pixel
        elif s < 280:
            bits.at = pos + n
            length = _value(bits, s - 256)
            code = _value(bits, far.read(bits))
            pos = bits.at
            if code > 120:
                distance = code - 120
            else:
                dx, dy = NEAR[code - 1]
                distance = max(1, dx + dy * width)
            if distance > at or at + length > total:
                raise ValueError("a back-reference out of the image")
            if distance >= length:
                out.extend(out[at - distance : at - distance + length])
            else:
                turn = out[at - distance : at]
                out.extend((turn * (length // distance + 1))[:length])
            if cache_bits:
                for pixel in out[at:]:
                    cache[(0x1E35A7BD * pixel & 0xFFFFFFFF) >> shift] = pixel
            at += length
        else:
            pos += n
            if pos > end:
                raise ValueError("the data ends early")
            out.append(cache[s - 280])
            at += 1
    bits.at = pos
    return out


def _planes(pixels) -> np.ndarray:
    """N x 4 of A, R, G, B as int16."""
    p = np.asarray(pixels, np.uint32)
    return np.stack([p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255], -1).astype(np.int16)


def predict(mode: int, left: tuple, top: tuple, corner: tuple, right: tuple) -> tuple:
    """The predicted pixel from its neighbours, each of A, R, G, B."""
    if mode == 0:
        return (255, 0, 0, 0)
    if mode in (1, 2, 3, 4):
        return (left, top, right, corner)[mode - 1]
    mean = lambda a, b: tuple((x + y) >> 1 for x, y in zip(a, b))
    if mode == 5:
        return mean(mean(left, right), top)
    if mode == 6:
        return mean(left, corner)
    if mode == 7:
        return mean(left, top)
    if mode == 8:
        return mean(corner, top)
    if mode == 9:
        return mean(top, right)
    if mode == 10:
        return mean(mean(left, corner), mean(top, right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner))
        to_top = sum(abs(x - c) for x, c in zip(left, corner))
        return left if to_left < to_top else top
    clamp = lambda x: 0 if x < 0 else 255 if x > 255 else x
    if mode == 12:
        return tuple(clamp(x + t - c) for x, t, c in zip(left, top, corner))
    if mode == 13:
        m = mean(left, top)
        return tuple(clamp(x + int((x - c) / 2)) for x, c in zip(m, corner))
    return (255, 0, 0, 0)


def _row(mode: int, start: int, end: int, width: int, known: np.ndarray, data: np.ndarray) -> None:
    """Undoes one predictor over known[start:end] of a row, neither its first pixel nor in the top row."""
    above = known[start - width : end - width]
    if mode in (0, 2, 3, 4, 8, 9) or mode > 13:
        corner = known[start - width - 1 : end - width - 1]
        if mode in (3, 9) and end % width == 0:  # the last pixel's upper right one is the first of its own row
            right = np.concatenate([known[start - width + 1 : end - width], known[end - width : end - width + 1]])
        else:
            right = known[start - width + 1 : end - width + 1]
        guess = {2: lambda: above, 3: lambda: right, 4: lambda: corner, 8: lambda: (corner + above) >> 1, 9: lambda: (above + right) >> 1}.get(mode, lambda: OPAQUE)()
        known[start:end] = (data[start:end] + guess) & 255
    elif mode == 1:
        known[start:end] = (np.cumsum(data[start:end], 0, dtype=np.int32) + known[start - 1]) & 255
    else:
        near = known[start - width - 1 : end - width + 1].tolist()
        left, out = known[start - 1].tolist(), []
        for k, residual in enumerate(data[start:end].tolist()):
            left = [(a + b) & 255 for a, b in zip(residual, predict(mode, left, near[k + 1], near[k], near[k + 2]))]
            out.append(left)
        known[start:end] = out


OPAQUE = np.array([255, 0, 0, 0], np.int16)


def run_predictor(pixels: np.ndarray, width: int, height: int, modes: list[int], tile: int, undo: bool) -> np.ndarray:
    """Adds the predictions to residuals (undo) or takes them from pixels; N x 4 of A, R, G, B."""
    across = _down(width, tile)
    if not undo:
        data = [tuple(p) for p in pixels.tolist()]
        out = []
        for i, own in enumerate(data):
            y, x = divmod(i, width)
            if not y:
                guess = data[i - 1] if x else (255, 0, 0, 0)
            elif not x:
                guess = data[i - width]
            else:
                guess = predict(modes[(y >> tile) * across + (x >> tile)], data[i - 1], data[i - width], data[i - width - 1], data[i - width + 1])
            out.append(tuple((a - b) & 255 for a, b in zip(own, guess)))
        return np.array(out, np.int64).reshape(-1, 4)
    known = np.zeros_like(pixels)
    known[:width] = (np.cumsum(pixels[:width], 0, dtype=np.int32) + OPAQUE) & 255
    for y in range(1, height):
        base = y * width
        known[base] = (pixels[base] + known[base - width]) & 255
        row = modes[(y >> tile) * across : (y >> tile) * across + across]
        x = 1
        while x < width:
            k = x >> tile
            stop = k + 1
            while stop < across and row[stop] == row[k]:
                stop += 1
            end = min(width, stop << tile)
            _row(row[k], base + x, base + end, width, known, pixels)
            x = end
    return known


def _signed(x: np.ndarray) -> np.ndarray:
    return (x ^ 128) - 128


def run_cross(p: np.ndarray, width: int, height: int, elements: np.ndarray, tile: int, undo: bool) -> np.ndarray:
    """elements: N x 4 of A, R, G, B holding red-to-blue, green-to-blue and green-to-red in R, G, B."""
    delta = lambda t, c: (_signed(t) * _signed(c)) >> 5
    sign = 1 if undo else -1
    out = p.copy()
    across = np.arange(width) >> tile
    for y in range(height):
        row = slice(y * width, (y + 1) * width)
        e, own = elements[(y >> tile) * _down(width, tile) + across].astype(np.int32), p[row].astype(np.int32)
        red = own[:, 1] + sign * delta(e[:, 3], own[:, 2]) & 255
        of = red if undo else own[:, 1]
        out[row, 1] = red
        out[row, 3] = own[:, 3] + sign * (delta(e[:, 2], own[:, 2]) + delta(e[:, 1], of)) & 255
    return out


def decode(data: bytes, max_pixels: int = MAX_PIXELS) -> np.ndarray:
    """H x W x 4 bytes of R, G, B, A; ValueError for anything that isn't a whole lossless WebP of at most max_pixels."""
    if len(data) < 20 or data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP")
    end = 8 + struct.unpack("<I", data[4:8])[0]
    if end > len(data):
        raise ValueError("the data ends early")
    at, body = 12, None
    while at + 8 <= end:
        size = struct.unpack("<I", data[at + 4 : at + 8])[0]
        if data[at : at + 4] == b"VP8L":
            body = data[at + 8 : at + 8 + size]
            if len(body) < size:
                raise ValueError("the data ends early")
            break
        at += 8 + size + (size & 1)
    if not body or body[0] != 0x2F:
        raise ValueError("not lossless")
    bits = Bits(body[1:])
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("an unknown version")
    if width * height > max_pixels:
        raise ValueError(f"{width} x {height} pixels are more than {max_pixels}")
    return decode_stream(bits, width, height)


def decode_stream(bits: Bits, width: int, height: int) -> np.ndarray:
    """H x W x 4 bytes of R, G, B, A of an image stream without its header."""
    steps, inner = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in [s[0] for s in steps]:
            raise ValueError("a transform given twice")
        if kind in (PREDICTOR, CROSS):
            tile = bits.read(3) + 2
            steps.append((kind, inner, tile, _planes(read_pixels(bits, _down(inner, tile), _down(height, tile), False))))
        elif kind == GREEN:
            steps.append((kind, inner, 0, None))
        else:
            n = bits.read(8) + 1
            colours = np.cumsum(_planes(read_pixels(bits, n, 1, False)), 0, dtype=np.int32) & 255
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            steps.append((kind, inner, pack, colours.astype(np.int16)))
            inner = _down(inner, pack)
    p = _planes(read_pixels(bits, inner, height, True))
    for kind, across, tile, extra in reversed(steps):
        if kind == PREDICTOR:
            p = run_predictor(p, across, height, (extra[:, 2] & 15).tolist(), tile, True)
        elif kind == CROSS:
            p = run_cross(p, across, height, extra, tile, True)
        elif kind == GREEN:
            p[:, 1] = p[:, 1] + p[:, 2] & 255
            p[:, 3] = p[:, 3] + p[:, 2] & 255
        else:
            g = p[:, 2].reshape(height, -1)
            depth = 8 >> tile
            x = np.arange(across)
            index = g[:, x >> tile] >> ((x & (1 << tile) - 1) * depth).astype(np.int16) & (1 << depth) - 1
            table = np.zeros((256, 4), np.int16)
            table[: len(extra)] = extra
            p = table[index.ravel()]
    return p[:, [1, 2, 3, 0]].astype(np.uint8).reshape(height, width, 4)


class Writer:
    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def bytes(self) -> bytes:
        return self.value.to_bytes((self.n + 7) // 8, "little")


def _lengths(counts: dict[int, int], size: int, most: int = 15) -> list[int]:
    """Huffman code lengths of at most `most` bits."""
    import heapq

    out = [0] * size
    counts = dict(counts) or {0: 1}
    if len(counts) == 1:
        out[next(iter(counts))] = 1
        return out
    while True:
        heap = [(c, s, (s,)) for s, c in counts.items()]
        heapq.heapify(heap)
        depth = dict.fromkeys(counts, 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= most:
            for s, n in depth.items():
                out[s] = n
            return out
        counts = {s: 1 + c // 2 for s, c in counts.items()}


def _put_code(w: Writer, lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Writes a prefix code and returns symbol -> (code, bits)."""
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and max(used) < 256:
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        w.put(1, 1)
        for s in used:
            w.put(s, 8)
        lengths = [int(s in used) for s in range(len(lengths))]
    else:
        w.put(0, 1)
        runs, i = [], 0
        while i < len(lengths):
            k = i
            while k < len(lengths) and lengths[k] == lengths[i]:
                k += 1
            n = k - i
            if not lengths[i] and n >= 3:
                n = min(n, 138)
                runs.append((18, n - 11, 7) if n >= 11 else (17, n - 3, 3))
            elif n >= 4 and lengths[i]:
                n = min(n, 7)
                runs += [(lengths[i], 0, 0), (16, n - 4, 2)]
            else:
                n = 1
                runs.append((lengths[i], 0, 0))
            i += n
        counts: dict[int, int] = {}
        for s, _, _ in runs:
            counts[s] = counts.get(s, 0) + 1
        of_lengths = _lengths(counts, 19, 7)
        w.put(15, 4)
        for s in CODE_ORDER:
            w.put(of_lengths[s], 3)
        w.put(0, 1)
        codes = {s: (c, n) for (n, c), s in canonical(of_lengths).items()}
        for s, extra, n in runs:
            w.put(*codes[s])
            w.put(extra, n)
    return {s: (c, n) for (n, c), s in canonical(lengths).items()}


def _symbol(value: int) -> tuple[int, int, int]:
    """(prefix symbol, extra bits, their number) of a length or distance."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    extra = top - 1
    second = v >> extra & 1
    return 2 * top + second, v - ((2 + second) << extra), extra


def _put_pixels(w: Writer, pixels: list[int], width: int, top: bool, cache_bits: int = 0, tile: int = 0, references: bool = True) -> None:
    height = len(pixels) // width
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    across, groups = _down(width, tile), 1
    meta = None
    if top:
        w.put(int(tile > 0), 1)
        if tile:
            meta = [i % 3 for i in range(across * _down(height, tile))]
            groups = max(meta) + 1
            w.put(tile - 2, 3)
            _put_pixels(w, [m << 8 | 0xFF << 24 for m in meta], across, False)
    near = {}
    for code, (dx, dy) in enumerate(NEAR, 1):
        near.setdefault(max(1, dx + dy * width), code)
    cache: dict[int, int] = {}
    seen: dict[tuple, int] = {}
    ops, i = [], 0
    key = lambda p: (0x1E35A7BD * p & 0xFFFFFFFF) >> 32 - cache_bits
    while i < len(pixels):
        length, origin = 0, seen.get(tuple(pixels[i : i + 3])) if references else None
        if origin is not None:
            while i + length < len(pixels) and length < 4096 and pixels[origin + length] == pixels[i + length]:
                length += 1
        if length >= 3:
            ops.append((i, length, near.get(i - origin, i - origin + 120)))
        else:
            length = 1
            if cache_bits and cache.get(key(pixels[i])) == pixels[i]:
                ops.append((i, 0, key(pixels[i])))
            else:
                ops.append((i, -1, pixels[i]))
        for k in range(i, i + length):
            if cache_bits:
                cache[key(pixels[k])] = pixels[k]
            seen[tuple(pixels[k : k + 3])] = k
        i += length
    counts = [[{} for _ in range(5)] for _ in range(groups)]
    plan = []
    for at, length, value in ops:
        g = meta[(at // width >> tile) * across + (at % width >> tile)] if meta else 0
        if length > 0:
            s, d = _symbol(length), _symbol(value)
            steps = [(0, 256 + s[0], s[1], s[2]), (4, d[0], d[1], d[2])]
        elif length == 0:
            steps = [(0, 280 + value, 0, 0)]
        else:
            steps = [(0, value >> 8 & 255, 0, 0), (1, value >> 16 & 255, 0, 0), (2, value & 255, 0, 0), (3, value >> 24, 0, 0)]
        for k, s, _, _ in steps:
            counts[g][k][s] = counts[g][k].get(s, 0) + 1
        plan.append((g, steps))
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[_put_code(w, _lengths(c, n)) for c, n in zip(group, sizes)] for group in counts]
    for g, steps in plan:
        for k, s, extra, n in steps:
            w.put(*codes[g][k][s])
            w.put(extra, n)


def _argb(p: np.ndarray) -> list[int]:
    return (p[:, 0] << 24 | p[:, 1] << 16 | p[:, 2] << 8 | p[:, 3]).tolist()


def encode(image: np.ndarray, transforms: tuple[int, ...] = (), cache_bits: int = 0, tile: int = 0, references: bool = True, modes=None, elements=None) -> bytes:
    """A lossless WebP of an H x W x 4 array of R, G, B, A bytes. transforms: in the order in which they are applied."""
    height, width = image.shape[:2]
    p = image.reshape(-1, 4).astype(np.int64)[:, [3, 0, 1, 2]]
    w = Writer()
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 1)
    w.put(0, 3)
    inner = width
    for kind in transforms:
        w.put(1, 1)
        w.put(kind, 2)
        if kind == PREDICTOR:
            n = _down(inner, 2) * _down(height, 2)
            chosen = list(modes) if modes is not None else [(k * 5 + 11) % 14 for k in range(n)]
            w.put(0, 3)
            _put_pixels(w, [m << 8 | 0xFF << 24 for m in chosen], _down(inner, 2), False)
            p = run_predictor(p, inner, height, chosen, 2, False)
        elif kind == CROSS:
            n = _down(inner, 2) * _down(height, 2)
            e = elements if elements is not None else np.stack([np.full(n, 255), np.arange(n) * 37 % 256, np.arange(n) * 91 % 256, np.arange(n) * 53 % 256], -1)
            w.put(0, 3)
            _put_pixels(w, _argb(e), _down(inner, 2), False)
            p = run_cross(p, inner, height, e, 2, False)
        elif kind == GREEN:
            p = p.copy()
            p[:, 1] = p[:, 1] - p[:, 2] & 255
            p[:, 3] = p[:, 3] - p[:, 2] & 255
        else:
            colours, index = np.unique(p, axis=0, return_inverse=True)
            n = len(colours)
            if n > 256:
                raise ValueError("more than 256 colours")
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            w.put(n - 1, 8)
            _put_pixels(w, _argb(np.diff(colours, axis=0, prepend=0) & 255), n, False)
            index = index.reshape(height, inner)
            narrow = _down(inner, pack)
            packed = np.zeros((height, narrow), np.int64)
            for x in range(inner):
                packed[:, x >> pack] |= index[:, x] << (x & (1 << pack) - 1) * (8 >> pack)
            inner = narrow
            p = np.zeros((height * narrow, 4), np.int64)
            p[:, 0], p[:, 2] = 255, packed.ravel()
    w.put(0, 1)
    _put_pixels(w, _argb(p), inner, True, cache_bits, tile, references)
    body = b"\x2f" + w.bytes()
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk


def decode_column(images: DataFrame, column: str = "image", keep: tuple[str, ...] = ("id",), max_pixels: int = MAX_PIXELS) -> DataFrame:
    """keep's columns, width, height, pixels (R, G, B, A bytes row by row) and error."""
    kept = len(keep)
    fields = [f"`{c}` {images.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                size, pixels, errors, held = [], [], [], 0
                first = at
                while at < whole.num_rows and held < 1 << 26:  # pixels of many images never wait for one another
                    data = whole.column(kept)[at].as_py()
                    at += 1
                    try:
                        image = None if data is None else decode(data, max_pixels)
                        size.append(None if image is None else image.shape[:2])
                        pixels.append(None if image is None else image.tobytes())
                        errors.append(None)
                        held += 0 if image is None else image.nbytes
                    except (ValueError, IndexError) as e:
                        size.append(None)
                        pixels.append(None)
                        errors.append(str(e))
                columns = [whole.column(i).slice(first, at - first) for i in range(kept)]
                columns += [pa.array([s and s[1] for s in size], pa.int32()), pa.array([s and s[0] for s in size], pa.int32()), pa.array(pixels, pa.binary()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "width", "height", "pixels", "error"])

    return images.select(*[F.col(c) for c in keep], F.col(column).alias("__image")).mapInArrow(run, ", ".join([*fields, "width int, height int, pixels binary, error string"]))


def thumbnails(embeddings: DataFrame) -> DataFrame:
    """(id, image): each vector as a small WebP heat map with about eight values a row, by features in turn (transforms,
    colour cache, entropy image); a null vector has a null image, an empty one a single clear pixel."""
    ways = (
        {"transforms": (PREDICTOR, CROSS, GREEN), "cache_bits": 4},
        {"transforms": (PALETTE,), "cache_bits": 3},
        {"transforms": (GREEN, PREDICTOR), "tile": 2},
        {"transforms": (CROSS,), "cache_bits": 6, "tile": 3},
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                images.append(None if v is None else encode(heat(v), **ways[(i or 0) % 4]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(images, pa.binary())], names=["id", "image"])

    return embeddings.select(F.col("vec_id").cast("long").alias("id"), "embedding").mapInArrow(run, "id long, image binary")


def heat(vector) -> np.ndarray:
    """The pixels of a vector's heat map."""
    v = np.nan_to_num(np.array([0.0 if x is None else x for x in vector], np.float64))
    if not len(v):
        return np.zeros((1, 1, 4), np.uint8)
    rows = -(-len(v) // 8)
    level = np.zeros(rows * 8)
    level[: len(v)] = np.clip((v + 1) / 2, 0, 1)
    step = np.floor(level * 24).astype(np.int64)
    p = np.stack([step * 10, 255 - step * 10, step * 7 % 256, np.full(len(step), 255)], -1)
    return p.astype(np.uint8).reshape(rows, 8, 4)
