"""Positions in a total order without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.session import written

#: An id of Spark's generator holds the task above these bits, and the row within the task below.
ROW_BITS = 33


def numbered(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """``df`` with each row's zero-based position by ``order``, which must tell rows apart for positions to be definite.

    Rows are dealt by ranges of the order and sorted there; the sorted ranges are written once, so that their limits can't
    change, and a window only adds up one row a range.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = written(sorted_.withColumn("_m", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_m", ROW_BITS)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    # One row a range: the number of shuffle partitions bounds it.
    out = ranked.withColumn("_part", part).join(F.broadcast(starts), "_part")
    row = F.col("_m").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return out.withColumn(name, F.col("_before") + row).drop("_m", "_part", "_before")
