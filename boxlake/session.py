"""Session and table helpers shared by every operator."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the Parquet tables below ``sf_dir`` through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Where it is unset, a session in one process (tests, notebooks) gets a folder of its own; a cluster must name one, as no
    machine-local folder would do there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file:///tmp/checkpoints/{spark.sparkContext.applicationId}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there and survives lost executors."""
    return _written(df, label)[0]


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Scratch:
    """Intermediate tables of one operator; ``clear`` removes them once what is returned no longer reads them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, label: str = "step") -> DataFrame:
        """As ``written``, and noted for removal."""
        out, path = _written(df, label)
        self.paths.append(path)
        return out

    def clear(self) -> None:
        hadoop = self.spark._jsc.hadoopConfiguration()
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
        self.paths = []


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for small frames in loops. With spark.cleaner.referenceTracking.cleanCheckpoints, Spark removes
    it when the frame is no longer referenced."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a frame read from ``written`` it comes from the files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
