"""Scalars of boxes: clamping, histogram bins and the four box-to-pixel conventions."""

from __future__ import annotations

import math
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: Column | float = 0.0, hi: Column | float = 1.0) -> Column:
    """NaN and null give null."""
    lo, hi = (v if isinstance(v, Column) else F.lit(v) for v in (lo, hi))
    return F.when(F.isnan(x.cast("double")), None).otherwise(F.greatest(lo, F.least(hi, x)))


def area(w: Column, h: Column) -> Column:
    return clamp(clamp(w) * clamp(h))


def num_bins(step: float) -> int:
    return math.ceil(1.0 / step)


def bin_index(x: Column, step: float) -> Column:
    """Division, not edges: values within 1e-12 of one fall into the last bin."""
    n = num_bins(step)
    return F.when(x >= 1.0 - 1e-12, n - 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(n - 1), (x / F.lit(step)).cast("int"))))


def bin_lo(b: Column, step: float) -> Column:
    return b * F.lit(step)


def bin_hi(b: Column, step: float) -> Column:
    """The last edge is one, so the last bin may be narrower."""
    return F.when(b == num_bins(step) - 1, F.lit(1.0)).otherwise((b + 1) * F.lit(step))


class Pixels(Enum):
    """CROP truncates and ends at the size; REVIEW and SCALED round half to even; POSE truncates; all clip to the image."""

    CROP = "crop"
    REVIEW = "review"
    SCALED = "scaled"
    POSE = "pose"


def to_pixels(convention: Pixels, scale: float = 1.0, xc: str = "xc", yc: str = "yc", w: str = "w", h: str = "h", img_w: str = "img_w", img_h: str = "img_h") -> dict[str, Column]:
    """Columns x1, y1, x2, y2 of a box under a convention."""

    def axis(center: str, size: str, dim: str) -> tuple[Column, Column]:
        c, s, d = F.col(center), F.col(size), F.col(dim)
        if convention in (Pixels.CROP, Pixels.POSE):
            a, b = ((c - s / 2) * d).cast("int"), ((c + s / 2) * d).cast("int")
        else:
            half = (s * d) * (scale if convention is Pixels.SCALED else 1.0) / 2
            a, b = F.rint(c * d - half).cast("int"), F.rint(c * d + half).cast("int")
        end = d if convention is Pixels.CROP else d - 1
        return F.greatest(F.lit(0), F.least(a, d - 1)), F.greatest(F.lit(0), F.least(b, end))

    (x1, x2), (y1, y2) = axis(xc, w, img_w), axis(yc, h, img_h)
    return {"x1": x1, "y1": y1, "x2": x2, "y2": y2}


def outline() -> dict[str, Column]:
    """Corner and size, from clamped values."""
    return {"x1": clamp(F.col("xc")) - clamp(F.col("w")) * 0.5, "y1": clamp(F.col("yc")) - clamp(F.col("h")) * 0.5, "bw": clamp(F.col("w")), "bh": clamp(F.col("h"))}


def fit(img_w: Column, img_h: Column, max_w: int, max_h: int) -> dict[str, Column]:
    """Size that keeps the ratio within a frame, at least one pixel each way; an empty image stays as it is."""
    scale = F.least(max_w / img_w, max_h / img_h)
    ok = (img_w > 0) & (img_h > 0)
    return {"fit_w": F.when(ok, F.greatest(F.lit(1), (img_w * scale).cast("int"))).otherwise(img_w), "fit_h": F.when(ok, F.greatest(F.lit(1), (img_h * scale).cast("int"))).otherwise(img_h)}


def keypoint_colors(v: Column) -> dict[str, Column]:
    """Ring and list chip differ: the ring rounds and takes two and more as green, the chip cuts and takes two alone."""
    ring, chip = F.rint(v).cast("int"), v.cast("int")
    return {"ring": F.when(ring >= 2, "green").when(ring == 1, "blue").otherwise("red"), "chip": F.when(chip == 2, "green").when(chip == 1, "blue").otherwise("red")}


def l2_normalized(v: Column, eps: float = 1e-12) -> Column:
    """The vector over its norm; a zero vector stays zero."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(F.array(norm), lambda n: F.transform(d, lambda x: x / F.when(n < eps, F.lit(1.0)).otherwise(n)))[0]


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero; what rounds to zero keeps its sign, as floating-point rounding has it and a decimal can't."""
    return F.transform(F.array(F.round(x, digits)), lambda r: F.when(r == 0, x * 0.0).otherwise(r))[0]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def mse(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def bits_differ(a: Column, b: Column) -> Column:
    """Hamming distance of arrays of 0 and 1."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda s, x: s + x)


def hamming(a: Column, b: Column) -> Column:
    """Hamming distance of two 64-bit hashes."""
    return F.bit_count(a.bitwiseXOR(b))
