"""Whole runs over folders, composed of the operators: the box-size report, and duplicates moved away in two stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import grammar as G
from boxlake.operators import cluster, dedup, geometry as geo, stats
from boxlake.operators.order import numbered
from boxlake.sources import files, sinks


@dataclass(frozen=True)
class HistogramRun:
    """meta: one row; hist: zero-filled; shown: without the fullest bins; outlines and centers: bounded samples for plots."""

    meta: DataFrame
    hist: DataFrame
    shown: DataFrame
    outlines: DataFrame
    centers: DataFrame


def outlines(boxes: DataFrame, most: int = 20_000, seed: int = 1) -> DataFrame:
    """(base, cls, x1, y1, bw, bh) of at most ``most`` boxes, the same for the same seed."""
    return _sampled(boxes, most, seed).select("base", "cls", *[c.alias(n) for n, c in geo.outline().items()])


def centers(boxes: DataFrame, most: int = 400_000, seed: int = 1) -> DataFrame:
    """(base, cls, x, y) of at most ``most`` boxes, clamped, the same for the same seed."""
    return _sampled(boxes, most, seed).select("base", "cls", geo.clamp(F.col("xc")).alias("x"), geo.clamp(F.col("yc")).alias("y"))


def _sampled(boxes: DataFrame, most: int, seed: int) -> DataFrame:
    return cluster.sample_exact(boxes, most, F.struct("base", "cls", "xc", "yc", "w", "h"), seed)


def histogram_run(spark: SparkSession, folders: list[str], step: float = 0.02, classes: list[int] | None = None, out: str | None = None, hidden: float = 0.2, seed: int = 1) -> HistogramRun:
    """The report over the label files of several folders (training and validation), told apart by folder and stem.

    Boxes count where the label file's image is there and readable. With ``out``, the histogram file is written.
    """
    labels = files.listing(spark, folders, kind="label").select("dir", "base")
    beside = files.images_beside(labels, files.listing(spark, folders, kind="review"))
    read = None
    for folder in folders:
        part = files.contents(spark, folder, recursive=False)
        read = part if read is None else read.unionByName(part)
    # A reader and a listing spell a path differently; both end in folder and name.
    key = lambda c: F.concat_ws("/", files.parent(F.col(c)), F.regexp_extract(c, r"([^/]*)$", 1)).alias("at")
    wanted = beside.filter("image is not null").select("dir", "base", key("image"))
    sized = files.image_sizes(read.select("content", key("path")).join(wanted, "at").select("dir", "base", "content"))
    # An image without a byte is there, but has no row in a reader: it is bad.
    state = F.when(F.col("image").isNull(), "missing").otherwise(F.coalesce("state", F.lit("bad")))
    images = beside.join(sized.select("dir", "base", "state"), ["dir", "base"], "left").select("dir", "base", state.alias("state"))
    boxes = files.label_boxes(spark, folders)
    meta = stats.run_meta(labels, images, boxes, ("dir", "base"))
    good = boxes.join(images.filter("state = 'ok'").select("dir", "base"), ["dir", "base"], "left_semi")
    hist = stats.histogram(good, step, classes)
    if out is not None:
        sinks.write_histogram({"bin_step": step} | meta.first().asDict(), hist, out)
    return HistogramRun(meta, hist, stats.top_bin_mask(hist, hidden, step), outlines(good, seed=seed), centers(good, seed=seed))


def hashed_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, ahash, phash, thumb) of all images below a root that decode; hashes as arrays of 64 bits."""
    from boxlake.functions import pixels

    bits = lambda c: F.transform(F.sequence(F.lit(63), F.lit(0)), lambda k: F.getbit(c, k).cast("int"))
    raw = files.decoded_images(spark, root, recursive=True).select("path", pixels.ahash_udf("height", "width", "data").alias("a"), pixels.phash_udf("height", "width", "data").alias("p"), pixels.thumbnail_udf("height", "width", "data").alias("thumb"))
    return raw.select("path", bits(F.col("a")).alias("ahash"), bits(F.col("p")).alias("phash"), "thumb")


def duplicate_run(spark: SparkSession, root: str, out: str, exact_stage: bool = True, near_stage: bool = True, most_bits: tuple[int, int] = (12, 11), most_mse: float = 50.0, bands: int = 8, op: str = "move") -> DataFrame:
    """(stage, op, src, dst): duplicates of images below ``root``, exact ones first, near ones among what is left, as a plan.

    near_members works on numbers, so paths are numbered in their order; the smallest path of a group is kept.
    """
    listed = numbered(files.listing(spark, root, recursive=True, kind="dedup").select("path"), "path", name="id")
    at: Column = F.regexp_replace("path", r"^([a-z0-9+.-]+):/+", "$1:/")
    bytes_of = files.contents(spark, root).select(at.alias("path"), "content")
    items = listed.select("id", at.alias("path")).join(bytes_of, "path", "left")

    def near(left: DataFrame) -> DataFrame:
        hashed = hashed_images(spark, root).withColumn("path", at).join(left.select("id", "path"), "path")
        return dedup.near_links(hashed, {"a": "ahash", "p": "phash"}, bands, "thumb", "id", most_bits, most_mse)

    dups = dedup.two_stage(items, F.col("content"), near, "id", exact_stage, near_stage)
    groups = numbered(dups.select("stage", "keep").distinct(), "stage", "keep", name="n")
    first = groups.groupBy("stage").agg(F.min("n").alias("first"))
    rows = dups.join(groups.join(first, "stage").select("stage", "keep", (F.col("n") - F.col("first")).alias("group_no")), ["stage", "keep"]).join(items.select("id", "path"), "id")
    below = G.relative_to(F.col("path"), files.qualified(spark, root))
    return rows.select("stage", F.lit(op).alias("op"), F.col("path").alias("src"), F.concat(F.lit(out.rstrip("/") + "/"), "stage", F.format_string("/group_%06d/", "group_no"), below).alias("dst"))
