"""Pixel kernels as Arrow-batched functions over raw images: numpy only, a row's image at a time, nothing gathered.

An image is (height, width, 3) bytes in BGR order, row by row, as Spark's image reader gives it. Hashes, histograms and
gradients follow their published definitions; values of libraries that resample or blur in their own way may differ.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StructType([T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType())]))
def header_size(content: pd.Series) -> pd.DataFrame:
    """Width and height from the header of a PNG, JPEG, BMP or WebP; null where there is none."""
    return pd.DataFrame([image_size(bytes(c) if c is not None else b"") for c in content], columns=["w", "h"]).astype("Int32")


def image_size(data: bytes) -> tuple[int | None, int | None]:
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
        if data[:2] == b"\xff\xd8":
            at = 2
            while at < len(data):
                while data[at] == 0xFF and data[at + 1] == 0xFF:
                    at += 1
                kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
                if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 + size
    except (struct.error, IndexError):
        pass
    return None, None


def _webp(data: bytes) -> tuple[int | None, int | None]:
    kind = data[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
    if kind == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    w, h = struct.unpack("<HH", data[26:30])
    return w & 0x3FFF, h & 0x3FFF


def pixels(row_h: int, row_w: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(row_h, row_w, -1)[:, :, :3]


def gray(bgr: np.ndarray) -> np.ndarray:
    return bgr.astype(np.float64) @ np.array([0.114, 0.587, 0.299])


def resized(image: np.ndarray, size: int) -> np.ndarray:
    """Square of ``size`` by area means (weights of partly covered pixels), for one channel or three."""

    def weights(n: int) -> np.ndarray:
        edges = np.linspace(0, n, size + 1)
        lo, hi = edges[:-1, None], edges[1:, None]
        cover = np.clip(np.minimum(hi, np.arange(1, n + 1)) - np.maximum(lo, np.arange(n)), 0, None)
        return cover / cover.sum(axis=1, keepdims=True)

    rows, cols = weights(image.shape[0]), weights(image.shape[1])
    return np.einsum("ah,hw...,bw->ab...", rows, image.astype(np.float64), cols, optimize=True)


def blurred(image: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(4 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        padded = np.pad(image, [(r, r) if a == axis else (0, 0) for a in range(image.ndim)], mode="edge")
        image = sum(w * np.take(padded, np.arange(i, i + image.shape[axis]), axis=axis) for i, w in enumerate(k))
    return image


def prepared(bgr: np.ndarray, size: int = 128, sigma: float = 0.6) -> np.ndarray:
    """What both hashes see: gray, square, lightly blurred."""
    return blurred(resized(gray(bgr), size), sigma)


def _bits(flags: np.ndarray) -> int:
    """64 flags as a signed 64-bit integer, the first flag highest."""
    return int(np.packbits(flags.ravel()).view(">i8")[0])


def average_hash(image: np.ndarray) -> int:
    small = resized(image, 8)
    return _bits(small > small.mean())


def perceptual_hash(image: np.ndarray) -> int:
    """Signs of the lowest 8 x 8 frequencies of a 32 x 32 cosine transform, against their median."""
    n = np.arange(32)
    basis = np.cos(np.pi * (2 * n + 1) * n[:, None] / 64)
    low = (basis @ resized(image, 32) @ basis.T)[:8, :8]
    return _bits(low > np.median(low))


def unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v)
    return v / n if n > 1e-12 else v


def gradients_histogram(bgr: np.ndarray, window: int = 96, cell: int = 8, bins: int = 9) -> np.ndarray:
    """Oriented gradients: votes split between two orientations, 2 x 2 cells a block, blocks normalised and clipped at 0.2."""
    g = resized(gray(bgr), window)
    gy, gx = np.gradient(g)
    size, angle = np.hypot(gx, gy), np.degrees(np.arctan2(gy, gx)) % 180
    pos = angle / (180 / bins) - 0.5
    low = np.floor(pos).astype(int)
    part, n = pos - low, window // cell
    cells = np.zeros((n, n, bins))
    row, col = np.indices(g.shape) // cell
    np.add.at(cells, (row, col, low % bins), size * (1 - part))
    np.add.at(cells, (row, col, (low + 1) % bins), size * part)
    blocks = [unit(np.minimum(unit(cells[i : i + 2, j : j + 2].ravel()), 0.2)) for i in range(n - 1) for j in range(n - 1)]
    return unit(np.concatenate(blocks))


def hsv(bgr: np.ndarray) -> np.ndarray:
    """Hue in [0, 180), saturation and value in [0, 256)."""
    b, g, r = (bgr[..., i].astype(np.float64) for i in range(3))
    v, low = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    d = v - low
    safe = np.where(d == 0, 1, d)
    h = np.select([d == 0, v == r, v == g], [0 * v, (g - b) / safe % 6, (b - r) / safe + 2], (r - g) / safe + 4) * 30
    return np.stack([h % 180, np.where(v == 0, 0, d / np.where(v == 0, 1, v) * 255), v], axis=-1)


def color_histogram(bgr: np.ndarray, bins: tuple[int, int, int] = (24, 8, 8)) -> np.ndarray:
    h, _ = np.histogramdd(hsv(bgr).reshape(-1, 3), bins, ((0, 180), (0, 256), (0, 256)))
    return h.ravel() / max(1.0, h.sum())


def feature(bgr: np.ndarray, shape_weight: float = 1.0, color_weight: float = 1.0, size: int = 128) -> np.ndarray:
    """Shape and colour of the image brought to a square, 5892 numbers, unit length."""
    colors = color_histogram(resized(bgr, size))
    return unit(np.concatenate([shape_weight * gradients_histogram(bgr), color_weight * unit(colors)])).astype(np.float32)


def edges(image: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Thin edges with hysteresis: weak ones stay where strong ones touch them."""
    p = np.pad(image, 1, mode="edge")
    at = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    gx = at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)
    gy = at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)
    m = np.abs(gx) + np.abs(gy)
    way = np.round(np.degrees(np.arctan2(gy, gx)) % 180 / 45).astype(int) % 4
    q = np.pad(m, 1)
    near = lambda dy, dx: q[1 + dy : q.shape[0] - 1 + dy, 1 + dx : q.shape[1] - 1 + dx]
    steps = ((0, 1), (1, 1), (1, 0), (1, -1))
    thin = np.zeros(m.shape, bool)
    for k, (dy, dx) in enumerate(steps):
        thin |= (way == k) & (m >= near(dy, dx)) & (m > near(-dy, -dx))
    keep, weak = thin & (m > high), thin & (m > low)
    while True:
        g = np.pad(keep, 1)
        grown = weak & (sum(g[1 + a : g.shape[0] - 1 + a, 1 + b : g.shape[1] - 1 + b] for a in (-1, 0, 1) for b in (-1, 0, 1)) > 0)
        if (grown == keep).all():
            return keep
        keep = grown


def coarse_signature(bgr: np.ndarray, grid: int = 8, bins: tuple[int, int, int] = (12, 4, 4), size: int = 128) -> bytes:
    """256 bytes of the image brought to a square: edge density of 8 x 8 cells, and a small colour histogram, both as bytes."""
    # Rounded, so that equal pixels stay equal where edges compare them.
    small = np.round(resized(bgr, size), 6)
    density = resized(edges(gray(small)).astype(np.float64), grid)
    cells = (density * 255).astype(np.uint8)
    colors = np.clip(color_histogram(small, bins) * 255, 0, 255).astype(np.uint8)
    return cells.tobytes() + colors.tobytes()


def crop(bgr: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    return bgr[y1:y2, x1:x2]


def png_bytes(bgr: np.ndarray) -> bytes:
    """A PNG file of the image, without loss; no JPEG encoder is at hand."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = bgr.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(bgr[:, :, ::-1]).reshape(h, -1)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def crops_udf(hs: pd.Series, ws: pd.Series, ds: pd.Series, boxes: pd.Series) -> pd.Series:
    """PNG files of an image's boxes (arrays of x1, y1, x2, y2), null for an empty one; the image is decoded once."""

    def one(image: np.ndarray, box) -> bytes | None:
        part = crop(image, *map(int, box))
        return png_bytes(part) if part.size else None

    return pd.Series([[one(pixels(int(h), int(w), bytes(d)), b) for b in bs] for h, w, d, bs in zip(hs, ws, ds, boxes, strict=True)], dtype=object)


def _per_image(f, kind: T.DataType):
    """A pandas UDF over (height, width, data); a row that is no image gives null."""

    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hs, ws, ds in parts:
            yield pd.Series([f(pixels(int(h), int(w), bytes(x))) if x is not None and h is not None and h > 0 else None for h, w, x in zip(hs, ws, ds, strict=True)], dtype=object)

    return F.pandas_udf(run, kind)


ahash_udf = _per_image(lambda x: average_hash(prepared(x)), T.LongType())
phash_udf = _per_image(lambda x: perceptual_hash(prepared(x)), T.LongType())
thumbnail_udf = _per_image(lambda x: resized(prepared(x), 32).ravel().tolist(), T.ArrayType(T.DoubleType()))
feature_udf = _per_image(lambda x: feature(x).tolist(), T.ArrayType(T.FloatType()))
signature_udf = _per_image(coarse_signature, T.BinaryType())
