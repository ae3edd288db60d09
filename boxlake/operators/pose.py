"""Keypoints and skeleton edges of an object, as seen in its crop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.operators import geometry as geo


def name_index(index: DataFrame) -> DataFrame:
    """(name, idx): a name that stands twice means its last place."""
    return index.groupBy("name").agg(F.max("idx").alias("idx"))


def _few(index: DataFrame, most: int = 4096) -> DataFrame:
    """A table of keypoint names or their pairs, to be sent to every task; one above ``most`` rows is refused."""
    if index.count() > most:
        raise ValueError(f"over {most} keypoints or edges")
    return F.broadcast(index)


def _inside(x: Column, y: Column) -> Column:
    return (x >= 0) & (y >= 0) & (x < F.col("x2") - F.col("x1")) & (y < F.col("y2") - F.col("y1"))


def points(objects: DataFrame, keypoints: DataFrame, index: DataFrame) -> DataFrame:
    """(base, idx, name, px, py, v, visible, ring, chip): each named keypoint of each object; an absent one has v 0.

    objects: base, x1, y1, x2, y2, img_w, img_h. Visible means inside the crop, whatever v is.
    """
    every = objects.crossJoin(_few(index.select("idx", "name")))
    j = every.join(keypoints.select("base", F.col("kpt_idx").alias("idx"), "kx", "ky", "v"), ["base", "idx"], "left")
    px, py = (F.col("kx") * F.col("img_w")).cast("int") - F.col("x1"), (F.col("ky") * F.col("img_h")).cast("int") - F.col("y1")
    v = F.coalesce("v", F.lit(0)).cast("double")
    j = j.withColumns({"px": px, "py": py})
    return j.select("base", "idx", "name", "px", "py", v.cast("int").alias("v"), F.coalesce(_inside(F.col("px"), F.col("py")), F.lit(False)).alias("visible"), *[c.alias(n) for n, c in geo.keypoint_colors(v).items()])


def edges(pts: DataFrame, skeleton: DataFrame, index: DataFrame) -> DataFrame:
    """(base, ord, ax, ay, bx, by): skeleton lines with both ends labelled and inside the crop."""
    names = name_index(index)
    pairs = skeleton.join(names.select(F.col("name").alias("n1"), F.col("idx").alias("i1")), "n1").join(names.select(F.col("name").alias("n2"), F.col("idx").alias("i2")), "n2")
    shown = pts.filter("visible and v > 0")
    a = shown.select("base", F.col("idx").alias("i1"), F.col("px").alias("ax"), F.col("py").alias("ay"))
    b = shown.select("base", F.col("idx").alias("i2"), F.col("px").alias("bx"), F.col("py").alias("by"))
    return a.join(_few(pairs), "i1").join(b, ["base", "i2"]).select("base", "ord", "ax", "ay", "bx", "by")


def header(index: DataFrame, keep: tuple[str, ...] = ("idx",)) -> DataFrame:
    """(idx, title), or the columns of ``keep`` and title: the comment where there is one, else the name."""
    return index.select(*keep, F.coalesce(F.nullif("comment", F.lit("")), F.col("name")).alias("title"))


def crop_state(images: DataFrame, objects: DataFrame) -> DataFrame:
    """(base, n_objects, state): 'No Objects Found', 'Invalid BBox', 'Empty Crop' or 'ok' for the first object of each image.

    A box is empty that has corners in order but no pixel of the image: its image has no pixels along one side.
    """
    first = objects.groupBy("base").agg(F.count(F.lit(1)).alias("n_objects"), F.min_by(F.struct("x1", "y1", "x2", "y2"), "ord").alias("f"))
    j = images.join(first, "base", "left")
    size = [c for c in ("img_w", "img_h") if c in images.columns]
    outside = F.greatest(F.lit(False), *[F.coalesce(F.col(c) <= F.col(f"f.{a}1"), F.lit(False)) for c, a in zip(("img_w", "img_h"), "xy", strict=True) if c in size]) if size else F.lit(False)
    state = F.when(F.col("f").isNull(), "No Objects Found").when((F.col("f.x2") <= F.col("f.x1")) | (F.col("f.y2") <= F.col("f.y1")), "Invalid BBox").when(outside, "Empty Crop").otherwise("ok")
    return j.select("base", F.coalesce("n_objects", F.lit(0)).alias("n_objects"), state.alias("state"))
