"""Class counts and shares, box-size histograms and their masks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxlake.operators import geometry as geo

METRICS = ("area", "height", "width")


def class_counts(labels: DataFrame) -> DataFrame:
    """(cls, n)."""
    return labels.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


def class_share(labels: DataFrame, files: DataFrame, label_dir: str) -> DataFrame:
    """(label_dir, total_txt_files, total_bboxes, class_id, count, ratio); without labels, one row of class '' and zeros.

    ``files`` has one row per label file, empty ones included.
    """
    counts = class_counts(labels)
    totals = labels.agg(F.count(F.lit(1)).alias("total_bboxes")).crossJoin(files.agg(F.count(F.lit(1)).alias("total_txt_files")))
    rows = totals.join(counts, F.lit(True), "left")
    ratio = F.when(F.col("total_bboxes") > 0, F.col("n") / F.col("total_bboxes").cast("double")).otherwise(0.0)
    return rows.select(F.lit(label_dir).alias("label_dir"), "total_txt_files", "total_bboxes", F.coalesce(F.col("cls").cast("string"), F.lit("")).alias("class_id"), F.coalesce("n", F.lit(0)).alias("count"), F.coalesce(ratio, F.lit(0.0)).alias("ratio"))


def box_bins(boxes: DataFrame, step: float) -> DataFrame:
    """(cls, metric, bin): three rows for each box."""
    w, h = geo.clamp(F.col("w")), geo.clamp(F.col("h"))
    values = boxes.select("cls", geo.bin_index(geo.area(F.col("w"), F.col("h")), step).alias("area"), geo.bin_index(h, step).alias("height"), geo.bin_index(w, step).alias("width"))
    return values.unpivot(["cls"], list(METRICS), "metric", "bin").dropna(subset=["bin"])


def histogram(boxes: DataFrame, step: float = 0.02, classes: list[int] | None = None) -> DataFrame:
    """(metric, class_id, bin, bin_lo, bin_hi, count), zero-filled: ALL and each class, listed or seen.

    Boxes are counted once by (metric, class, bin) with partial aggregation; ALL is the sum over those few rows. ALL counts
    every box, listed or not.
    """
    spark, n = boxes.sparkSession, geo.num_bins(step)
    counts = box_bins(boxes, step).groupBy("metric", "cls", "bin").agg(F.count(F.lit(1)).alias("count"))
    sums = counts.groupingSets([("metric", "cls", "bin"), ("metric", "bin")], "metric", "cls", "bin").agg(F.sum("count").alias("count"), F.grouping("cls").alias("all"))
    sums = sums.select("metric", F.when(F.col("all") == 1, "ALL").otherwise(F.col("cls").cast("string")).alias("class_id"), "bin", "count")
    names = counts.select(F.col("cls").cast("string").alias("class_id")).distinct() if classes is None else spark.createDataFrame([(str(c),) for c in classes], "class_id string")
    names = names.union(spark.createDataFrame([("ALL",)], "class_id string"))
    bins = spark.range(n).select(F.col("id").cast("int").alias("bin"), F.explode(F.array(*map(F.lit, METRICS))).alias("metric"))
    grid = F.broadcast(bins).join(names, F.lit(True))
    out = grid.join(sums, ["metric", "class_id", "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select("metric", "class_id", "bin", geo.bin_lo(F.col("bin"), step).alias("bin_lo"), geo.bin_hi(F.col("bin"), step).alias("bin_hi"), "count")


def top_bin_mask(hist: DataFrame, share: float = 0.2, step: float = 0.02) -> DataFrame:
    """The histogram with ``shown``: the count, or null in the fullest bins of ALL (ties: the lower bin) of its metric."""
    k = math.ceil(geo.num_bins(step) * share)
    rank = F.row_number().over(Window.partitionBy("metric").orderBy(F.col("count").desc(), "bin"))
    top = hist.filter("class_id = 'ALL'").withColumn("r", rank).filter(F.col("r") <= k).select("metric", "bin", F.lit(True).alias("cut"))
    return hist.join(F.broadcast(top), ["metric", "bin"], "left").withColumn("shown", F.when(F.col("cut").isNull(), F.col("count"))).drop("cut")


def first_classes(hist: DataFrame, most: int = 3) -> DataFrame:
    """Plot rows: ALL and the ``most`` smallest class ids, with bin centres."""
    rank = F.dense_rank().over(Window.partitionBy("metric").orderBy(F.when(F.col("class_id") != "ALL", F.col("class_id").cast("int")).asc_nulls_last()))
    out = hist.withColumn("r", rank).filter((F.col("class_id") == "ALL") | (F.col("r") <= most))
    return out.withColumn("center", (F.col("bin_lo") + F.col("bin_hi")) / 2).drop("r")


def long_labels(hist: DataFrame) -> DataFrame:
    """Rows of the histogram file: edges with four decimals."""
    edge = lambda c: F.format_string("%.4f", c)
    return hist.select("metric", "class_id", edge("bin_lo").alias("bin_lo"), edge("bin_hi").alias("bin_hi"), "count")


def run_meta(files: DataFrame, images: DataFrame, boxes: DataFrame, key: tuple[str, ...] = ("base",)) -> DataFrame:
    """One row: total_txt, missing_img, bad_img, total_boxes; boxes count only where the image is there and readable.

    files: one row a label file. ``key`` tells files apart: ("dir", "base") where folders share stems.
    """
    key = list(key)
    joined = files.select(*key).join(images.select(*key, "state"), key, "left")
    heads = joined.agg(F.count(F.lit(1)).alias("total_txt"), F.count_if(F.coalesce("state", F.lit("missing")) == "missing").alias("missing_img"), F.count_if(F.col("state") == "bad").alias("bad_img"))
    good = boxes.join(images.filter("state = 'ok'").select(*key), key, "left_semi").agg(F.count(F.lit(1)).alias("total_boxes"))
    return heads.crossJoin(good)


def count_report(share: DataFrame) -> DataFrame:
    """(ord, line): the counts as text, files and boxes first, then a line a class in order of its number."""
    head = share.select("total_txt_files", "total_bboxes").distinct()
    first = head.select(F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.concat(F.lit("label files: "), "total_txt_files").alias("line")), F.struct(F.lit(1).alias("ord"), F.concat(F.lit("boxes: "), "total_bboxes").alias("line")))).alias("x")).select("x.*")
    rank = F.row_number().over(Window.orderBy(F.col("class_id").try_cast("int"), "class_id")) + 1
    # One row a class.
    rest = share.filter("class_id <> ''").select(rank.alias("ord"), F.format_string("class %s: %d (%.2f%%)", "class_id", "count", F.col("ratio") * 100).alias("line"))
    return first.unionByName(rest).orderBy("ord")
