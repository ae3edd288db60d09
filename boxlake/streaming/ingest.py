"""Label and review streams: running class counts, late-bounded window counts, and the latest status by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.operators import parse


def label_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(base, line) of label files as they arrive."""
    lines = spark.readStream.option("pathGlobFilter", "*.[tT][xX][tT]").text(folder)
    return lines.select(F.regexp_replace(F.col("_metadata.file_name"), r"(?<=[^.])\.[^.]*$", "").alias("base"), F.col("value").alias("line"))


def running_counts(lines: DataFrame, variant: parse.Variant = parse.Variant.LENIENT_COUNT) -> DataFrame:
    """(cls, n) so far; state holds one row a class."""
    return parse.parse_labels(lines, variant).groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(events: DataFrame, ts: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, end, key, n) of tumbling windows; state is dropped once the watermark has passed a window."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("w.start", "w.end", key, "n")


def latest_reviews(events: DataFrame, key: str = "relkey", order: str = "seq") -> DataFrame:
    """(relkey, status) by the last event of each key, in update mode."""
    return events.groupBy(key).agg(F.max_by("status", order).alias("status"))


def upsert_reviews(path: str, order: str = "seq"):
    """foreachBatch sink: merges each batch into a Parquet folder of one version a batch, idempotent by batch id.

    Of a key's several events in one batch the last by ``order`` counts; without such a column, the highest status.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        old = max((int(n[2:]) for n in names if n.startswith("v=") and int(n[2:]) < batch_id), default=None)
        last = batch.groupBy("relkey").agg(F.max_by("status", order if order in batch.columns else "status").alias("status"))
        rows = last.select("relkey", "status", F.lit(1).alias("turn"))
        if old is not None:
            rows = spark.read.parquet(f"{path}/v={old}").select("relkey", "status", F.lit(0).alias("turn")).unionByName(rows)
        rows.groupBy("relkey").agg(F.max_by("status", "turn").alias("status")).write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return merge
