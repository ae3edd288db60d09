"""Labels and images by file stem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_priority(files: DataFrame, key: str | tuple[str, ...] = "base", prio: str = "prio") -> DataFrame:
    """(key..., first_ext, last_ext): of several files with one stem, the first and the last by extension priority.

    Files of several folders need the folder in the key: ("dir", "base"). One aggregate with partial results; no window.
    """
    return files.groupBy(*([key] if isinstance(key, str) else key)).agg(F.min_by("ext", prio).alias("first_ext"), F.max_by("ext", prio).alias("last_ext"))


def with_image(labels: DataFrame, images: DataFrame, key: str = "base") -> DataFrame:
    """Inner join on the stem."""
    return labels.join(images, key)


def without(left: DataFrame, right: DataFrame, key: str = "base") -> DataFrame:
    """Distinct stems on the left side that the right side lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
