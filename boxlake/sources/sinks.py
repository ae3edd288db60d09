"""Writers, and the explicit step that applies a plan of file actions.

Deletes, copies and moves are rows first; ``apply_actions`` has tasks carry them out, dry by default. Repeating an applied
plan changes nothing and reports 'gone'.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import pixels
from boxlake.operators import geometry as geo, parse, stats
from boxlake.sources.actions import ACTIONS, OPS, carried_out
from boxlake.sources.single import write_files


def actions(plan: DataFrame, src_root: str = "", dst_root: str = "") -> DataFrame:
    """(op, src, dst) with full paths from a plan of (relkey, op[, dst]); rows of no action drop out."""
    dst = F.when(F.col("dst").isNotNull(), F.concat(F.lit(dst_root), F.col("dst"))) if "dst" in plan.columns else F.lit(None).cast("string")
    return plan.filter(F.col("op").isin(*OPS)).select("op", F.concat(F.lit(src_root), F.col("relkey")).alias("src"), dst.alias("dst"))


def tree_plan(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(op, src, dst): the removal of whole folders, as rows of a plan."""
    return spark.createDataFrame([("rmtree", f, None) for f in folders], ACTIONS)


def apply_actions(plan: DataFrame, dry_run: bool = True, journal: str | None = None) -> DataFrame:
    """(op, src, dst, result): 'dry', or what became of each action when tasks carried them out (``actions.carried_out``)."""
    return plan.withColumn("result", F.lit("dry")) if dry_run else carried_out(plan, journal)


def write_labels(files: DataFrame, root: str) -> int:
    """Writes ``rewritten_labels`` (base, lines) as ``root``/base.txt, each line ended; a file that lost all lines is empty."""
    text = F.when(F.size("lines") > 0, F.concat(F.array_join("lines", "\n"), F.lit("\n"))).otherwise("")
    return write_files(files.select(F.concat("base", F.lit(".txt")).alias("name"), text.alias("content")), root)


def crops(images: DataFrame, boxes: DataFrame, ext: str = ".png") -> DataFrame:
    """(name, content): each box cut out of its image, as a PNG file named by its record; empty boxes have none.

    images: (base, height, width, data); boxes: (base, cls, xc, yc, w, h), at most a few thousand on an image. An image is cut
    beside its boxes, in one function over Arrow batches.
    """
    sized = boxes.join(images.select("base", F.col("width").alias("img_w"), F.col("height").alias("img_h")), "base").withColumns(geo.to_pixels(geo.Pixels.CROP))
    named = sized.select("base", parse.crop_name(F.col("base"), F.col("cls"), F.col("xc"), F.col("yc"), F.col("w"), F.col("h"), ext).alias("name"), F.array("x1", "y1", "x2", "y2").alias("box"))
    # Equal records are one file.
    own = named.distinct().groupBy("base").agg(F.sort_array(F.collect_list(F.struct("name", "box"))).alias("own"))
    cut = images.join(own, "base").select("own", pixels.crops_udf("height", "width", "data", F.transform("own", lambda o: o["box"])).alias("cut"))
    return cut.select(F.explode(F.zip_with("own", "cut", lambda o, c: F.struct(o["name"].alias("name"), c.alias("content")))).alias("f")).select("f.*").filter("content is not null")


def run_log(results: DataFrame) -> DataFrame:
    """(line,) in order of src: what was done or would be, one line an action."""
    mark = F.when(F.col("result") == "dry", "[DRY]").when(F.col("result") == "ok", "[OK]").when(F.col("result") == "gone", "[MISS]").otherwise("[SKIP]")
    return results.orderBy("src", "op").select(F.concat_ws(" ", mark, F.concat("op", F.lit(":")), "src", F.concat(F.lit("-> "), "dst")).alias("line"))


def write_counts(share: DataFrame, path: str) -> None:
    """Counts by class as one CSV file with a header, in order of class."""
    share.orderBy(F.col("class_id").try_cast("int")).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def histogram_lines(meta: dict[str, object], hist: DataFrame) -> DataFrame:
    """(line,) in order: key,value lines, an empty line, the header, then the histogram, ALL first.

    The histogram has a few hundred rows, so one task writes it.
    """
    head = ["key,value", *[f"{k},{v}" for k, v in meta.items()], "", "metric,class_id,bin_lo,bin_hi,count"]
    top = hist.sparkSession.createDataFrame([(0, i, 0, 0, line) for i, line in enumerate(head)], "part int, a int, b int, c int, line string")
    cls = F.when(F.col("class_id") == "ALL", -1).otherwise(F.col("class_id").try_cast("int"))
    metric = F.when(F.col("metric") == "area", 0).when(F.col("metric") == "width", 1).otherwise(2)
    keyed = hist.withColumns({"a": cls, "b": metric, "c": F.col("bin")})
    labels = stats.long_labels(keyed).columns
    rows = keyed.select(F.lit(1).alias("part"), "a", "b", "c", F.concat_ws(",", "metric", "class_id", F.format_string("%.4f", "bin_lo"), F.format_string("%.4f", "bin_hi"), "count").alias("line"))
    assert labels[0] == "metric"
    return top.union(rows).orderBy("part", "a", "b", "c").select("line")


def write_histogram(meta: dict[str, object], hist: DataFrame, path: str) -> None:
    histogram_lines(meta, hist).coalesce(1).write.mode("overwrite").text(path)


def save_reviews(reviews: DataFrame, path: str) -> None:
    """(relkey, status) as one file of JSON lines, in order of relkey.

    It is written beside the old file and renamed over it, so that readers see one or the other where the store's rename
    replaces a file at once, as HDFS and POSIX folders do.
    """
    spark = reviews.sparkSession
    beside = f"{path}.{uuid.uuid4().hex}"
    reviews.select("relkey", "status").orderBy("relkey").coalesce(1).write.json(beside)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(beside), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(parts[0]), fs.makeQualified(target), over)
    fs.delete(folder, True)


def load_reviews(spark, path: str) -> DataFrame:
    return spark.read.schema("relkey string, status int").json(path)


def rewritten_labels(kept: DataFrame, original: DataFrame, line: str = "line") -> DataFrame:
    """(base, lines): files that lost a line, with the lines left, in order; untouched files don't appear.

    kept and original: (base, line_no, line). An array holds one file's lines.
    """
    before = original.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    after = kept.groupBy("base").agg(F.count(F.lit(1)).alias("m"), F.transform(F.sort_array(F.collect_list(F.struct("line_no", line))), lambda r: r[line]).alias("lines"))
    return before.join(after, "base", "left").filter(F.coalesce("m", F.lit(0)) < F.col("n")).select("base", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))


def rewritten_files(files: DataFrame, keep: Callable[[Column], Column]) -> DataFrame:
    """(base, lines): as ``rewritten_labels``, where a line alone tells whether it stays, of whole files (base, text).

    A file is rewritten in its row, so no line is shuffled and files are read once. Empty lines count as none; a line of
    which ``keep`` gives null goes.
    """
    lines = F.filter(F.split("text", r"\r\n|\r|\n"), lambda x: x != "")
    split = files.select("base", F.transform(F.array(lines), lambda x: F.struct(F.size(x).alias("n"), F.filter(x, keep).alias("lines")))[0].alias("f"))
    return split.filter(F.size("f.lines") < F.col("f.n")).select("base", "f.lines")


def describe(plan: DataFrame) -> str:
    """The plan's log: number of actions by kind, as one JSON line."""
    return json.dumps({r["op"]: r["n"] for r in plan.groupBy("op").agg(F.count(F.lit(1)).alias("n")).collect()}, sort_keys=True)
