import base64
import itertools
import struct
import sysconfig
import zlib
from pathlib import Path

import numpy as np
import pytest

from marlstone.llm import webp as W


def picture(seed, h, w, colours=None):
    rng = np.random.default_rng(seed)
    if colours:
        table = rng.integers(0, 256, (colours, 4), np.uint8)
        return table[rng.integers(0, colours, (h, w)) * (rng.random((h, w)) < 0.6)]
    y, x = np.mgrid[:h, :w]
    smooth = np.stack([x * 3 + y, y * 5, x * y // 3, 255 - x], -1) % 256
    return (smooth + rng.integers(0, 3, (h, w, 4))).astype(np.uint8)


def test_public_sample():
    """The 1 x 1 lossless image of the widespread feature test."""
    image = W.decode(base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA=="))
    assert image.shape == (1, 1, 4)


def png(path):
    """H x W x 4 of a PNG with 8 bits a channel or a palette, by nothing but zlib."""
    data, at, body, palette, clear = path.read_bytes(), 8, b"", None, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, depth, colour = struct.unpack(">IIBB", part[:10])
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            clear = part
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    channels = {2: 3, 3: 1, 6: 4}[colour]
    raw, step = zlib.decompress(body), (w * channels * depth + 7) // 8
    rows, above, bpp = [], [0] * step, max(1, channels * depth // 8)
    for y in range(h):
        kind, line = raw[y * (step + 1)], list(raw[y * (step + 1) + 1 : (y + 1) * (step + 1)])
        for i in range(step):
            a, b, c = (line[i - bpp] if i >= bpp else 0), above[i], (above[i - bpp] if i >= bpp else 0)
            p = a + b - c
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line[i] = (line[i] + (0, a, b, (a + b) // 2, near)[kind]) & 255
        rows.append(line)
        above = line
    flat = np.array(rows, np.uint8)
    if colour == 3:
        index = np.unpackbits(flat, axis=1).reshape(h, -1, depth)[:, :w] @ (1 << np.arange(depth)[::-1])
        alpha = np.full(len(palette), 255, np.uint8)
        alpha[: len(clear)] = np.frombuffer(clear, np.uint8)
        return np.dstack([palette[index], alpha[index]])
    flat = flat.reshape(h, w, channels)
    return flat if channels == 4 else np.dstack([flat, np.full((h, w), 255, np.uint8)])


def test_a_stream_of_another_encoder_with_known_pixels():
    """Python's own test pictures: the WebP holds its alpha as a lossless stream, the PNG the same alpha."""
    folder = Path(sysconfig.get_paths()["stdlib"]) / "test" / "test_email" / "data"
    if not (folder / "python.webp").exists():
        pytest.skip("Python is installed without its tests")
    data, want = (folder / "python.webp").read_bytes(), png(folder / "python.png")
    at = data.index(b"ALPH")
    size = struct.unpack("<I", data[at + 4 : at + 8])[0]
    head, body = data[at + 8], data[at + 9 : at + 8 + size]
    assert head & 3 == 1 and head >> 2 & 3 == 0  # lossless, no filter
    image = W.decode_stream(W.Bits(body), want.shape[1], want.shape[0])
    assert (image[..., 1] == want[..., 3]).all() and len(np.unique(want[..., 3])) > 2


def predictor_by_the_book(modes, tile, residuals, width, height):
    """The format's rules pixel by pixel, one channel at a time, with nothing from the decoder."""
    out = np.zeros((height, width, 4), int)
    half = lambda a, b: (a + b) // 2
    for y in range(height):
        for x in range(width):
            m = modes[(y >> tile) * -(-width // (1 << tile)) + (x >> tile)]
            L = out[y, x - 1] if x else None
            T = out[y - 1, x] if y else None
            if y == 0 and x == 0:
                guess = np.array([255, 0, 0, 0])
            elif y == 0:
                guess = L
            elif x == 0:
                guess = T
            else:
                TL = out[y - 1, x - 1]
                TR = out[y - 1, x + 1] if x + 1 < width else out[y, 0]
                plus = np.clip(L + T - TL, 0, 255)
                mean = half(L, T)
                diff = mean - TL
                nearer = L if np.abs(L + T - TL - L).sum() < np.abs(L + T - TL - T).sum() else T
                guess = [np.array([255, 0, 0, 0]), L, T, TR, TL, half(half(L, TR), T), half(L, TL), half(L, T), half(TL, T), half(T, TR), half(half(L, TL), half(T, TR)), nearer, plus, np.clip(mean + np.sign(diff) * (np.abs(diff) // 2), 0, 255)][m]
            out[y, x] = (residuals[y, x] + guess) % 256
    return out


@pytest.mark.parametrize("seed", range(6))
def test_predictors_by_the_book(seed):
    rng = np.random.default_rng(seed)
    width, height = int(rng.integers(1, 40)), int(rng.integers(1, 30))
    modes = rng.integers(0, 14, -(-width // 4) * -(-height // 4)).tolist()
    residuals = rng.integers(0, 256, (height, width, 4))
    got = W.run_predictor(residuals.reshape(-1, 4).astype(np.int16), width, height, modes, 2, True)
    assert (got.reshape(height, width, 4) == predictor_by_the_book(modes, 2, residuals, width, height)).all()


def test_too_many_pixels_are_an_error_at_once(spark):
    bomb = b"\x2f" + struct.pack("<I", (16383 | 16383 << 14)) + b"\x88\x88\x08" * 4
    bomb = b"RIFF" + struct.pack("<I", 12 + len(bomb)) + b"WEBPVP8L" + struct.pack("<I", len(bomb)) + bomb
    images = spark.createDataFrame([(1, bomb), (2, W.encode(picture(1, 3, 3)))], "id long, image binary")
    got = {r.id: r for r in W.decode_column(images).collect()}
    assert got[1].pixels is None and "more than" in got[1].error and got[2].error is None
    assert W.decode_column(images, max_pixels=8).where("error IS NULL").count() == 0


def test_large_images():
    image = picture(9, 90, 310)
    for order in ((W.PREDICTOR, W.CROSS, W.GREEN), ()):
        assert (W.decode(W.encode(image, order, cache_bits=6, tile=4, modes=None)) == image).all()


@pytest.mark.parametrize("order", [o for n in range(4) for o in itertools.permutations((W.PREDICTOR, W.CROSS, W.GREEN), n)])
def test_transforms(order):
    image = picture(1, 11, 13)
    assert (W.decode(W.encode(image, order)) == image).all()


@pytest.mark.parametrize("colours", [1, 2, 4, 5, 16, 17, 200])
def test_palettes(colours):
    image = picture(2, 9, 21, colours)
    for more in ((), (W.PREDICTOR,), (W.GREEN,)):
        assert (W.decode(W.encode(image, (W.PALETTE, *more), cache_bits=5)) == image).all()


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    image = picture(3, 10, 10)
    assert (W.decode(W.encode(image, (W.PREDICTOR,), modes=[mode] * 9)) == image).all()


@pytest.mark.parametrize(("cache", "tile", "references"), list(itertools.product((0, 1, 6, 11), (0, 2, 4), (False, True))))
def test_entropy_coding(cache, tile, references):
    for image in (picture(4, 17, 40, 6), picture(5, 1, 300, 3), picture(6, 90, 3, 4), picture(7, 20, 20)):
        assert (W.decode(W.encode(image, (), cache, tile, references)) == image).all()


def test_predictor_by_hand():
    left, top, corner, right = (10, 20, 30, 40), (50, 61, 70, 80), (90, 100, 110, 120), (130, 140, 151, 160)
    assert W.predict(5, left, top, corner, right) == (60, 70, 80, 90)
    assert W.predict(11, left, top, corner, right) == left
    assert W.predict(12, left, top, corner, right) == (0, 0, 0, 0)
    assert W.predict(13, (200,) * 4, (210,) * 4, (100,) * 4, right) == (255,) * 4
    assert W.predict(13, (10,) * 4, (11,) * 4, (13,) * 4, right) == (9,) * 4


def test_distance_map():
    assert len(W.NEAR) == 120 and len(set(W.NEAR)) == 120
    assert all(dy > 0 or dx > 0 for dx, dy in W.NEAR) and W.NEAR[0] == (0, 1) and W.NEAR[119] == (8, 7)


def test_broken_streams_never_crash():
    good = W.encode(picture(8, 8, 8), (W.PREDICTOR, W.CROSS, W.GREEN), 4, 2)
    rng = np.random.default_rng(0)
    for k in range(len(good)):
        with pytest.raises((ValueError, IndexError)):
            W.decode(good[:k])
    for _ in range(300):
        bad = bytearray(good)
        bad[rng.integers(12, len(bad))] ^= 1 << int(rng.integers(8))
        try:
            W.decode(bytes(bad))
        except (ValueError, IndexError):
            pass


def test_query_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = {r.vec_id: W.heat(r.embedding) for r in vectors.collect()}
    out = W.decode_column(W.thumbnails(vectors)).collect()
    assert len(out) == len(want)
    for r in out:
        image = want[r.id]
        assert (r.height, r.width) == image.shape[:2] and bytes(r.pixels) == image.tobytes() and r.error is None


def test_edge_rows(spark):
    rows = [(1, None), (2, b""), (3, b"RIFF????WEBPVP8 "), (4, W.encode(picture(1, 2, 2))), (4, W.encode(picture(1, 2, 2))), (None, W.encode(picture(1, 2, 2))[:-6])]
    images = spark.createDataFrame([(*r, 5) for r in rows], "id long, image binary, width int")
    got = sorted(((r.id or -1), r.width, r.error is not None) for r in W.decode_column(images).collect())
    assert got == [(-1, None, True), (1, None, False), (2, None, True), (3, None, True), (4, 2, False), (4, 2, False)]
    assert W.decode_column(images.limit(0)).count() == 0
    vectors = spark.createDataFrame([(1, None), (2, []), (3, [0.5, None])], "vec_id long, embedding array<float>")
    assert {r.id: r.width for r in W.decode_column(W.thumbnails(vectors)).collect()} == {1: None, 2: 1, 3: 8}
