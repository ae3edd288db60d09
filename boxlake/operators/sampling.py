"""Samples of an exact size without gathering or sorting rows.

Every key draws a number of 60 bits. The n-th smallest number is found by counting: a round counts the rows of each of 32,768
ranges of the numbers, and the range that holds the n-th is the next round's, so two or three narrow scans reach a limit
below which exactly n rows lie. The sample is then a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.session import written

BITS, ROUND_BITS = 60, 15
HASH, PLACE = "_boxlake_draw", "_boxlake_place"


def draw(key: Column, seed: int) -> Column:
    """The first 60 bits of md5(key as text, ':', seed); a null key draws as an empty text."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")


def limit_of(numbers: DataFrame, n: int) -> tuple[int, int, int]:
    """(limit, ties, rows) for one column of numbers of 60 bits: the n smallest are all below the limit and ``ties`` of those at it.

    With at most n rows the limit lies above them all. Each round collects a count for each range, however many rows there are.
    """
    (name,) = numbers.columns
    low, below, rows = 0, 0, None
    for shift in range(BITS - ROUND_BITS, -1, -ROUND_BITS):
        inside = numbers.filter((F.col(name) >= low) & (F.col(name) < low + (1 << shift + ROUND_BITS)))
        counts = sorted(map(tuple, inside.groupBy(F.shiftright(F.col(name) - low, shift).cast("int").alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()))
        if rows is None:
            rows = sum(c for _, c in counts)
            if rows <= n:
                return 1 << BITS, 0, rows
        if n <= 0:
            return 0, 0, rows
        for at, count in counts:
            if below + count >= n:
                break
            below += count
        if below + count == n:
            return low + (at + 1 << shift), 0, rows
        low += at << shift
    return low, n - below, rows


def sample_counted(df: DataFrame, n: int, key: Column, seed: int = 1) -> tuple[DataFrame, int]:
    """``sample_exact``, and the number of rows of ``df``."""
    drawn = df.withColumn(HASH, draw(key, seed))
    limit, ties, rows = limit_of(drawn.select(HASH), n)
    if rows <= n:
        return df, rows
    out = drawn.filter(F.col(HASH) < limit).drop(HASH)
    if ties:
        # Rows of one key, of which some are taken: by their values, and among equal rows by their place.
        tied = written(drawn.filter(F.col(HASH) == limit).drop(HASH), "tied")
        every = tied.withColumn(HASH, draw(F.struct("*"), seed))
        limit, ties, _ = limit_of(every.select(HASH), ties)
        out = out.unionByName(every.filter(F.col(HASH) < limit).drop(HASH))
        if ties:
            equal = written(every.filter(F.col(HASH) == limit).drop(HASH).withColumn(PLACE, F.monotonically_increasing_id()), "equal")
            equal = equal.withColumn(HASH, draw(F.col(PLACE), seed)).drop(PLACE)
            out = out.unionByName(equal.filter(F.col(HASH) < limit_of(equal.select(HASH), ties)[0]).drop(HASH))
    return out, rows


def sample_exact(df: DataFrame, n: int | None, key: Column, seed: int = 1) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer, or n is None), the same for the same seed: the smallest draws of the keys.

    A null key draws like an empty one. Of rows that share a key at the limit, those are taken whose values draw lowest.
    """
    return df if n is None else sample_counted(df, n, key, seed)[0]
