"""Whitening of embeddings by a two-pass covariance.

The first pass adds up the distinct integer vectors exactly, which gives the mean; the second subtracts it from every vector
and adds outer products of what is left, a matrix product of numpy a batch. Each partition gives one vector or one matrix,
and treeAggregate merges them level by level, so the driver gets a few, whatever the number of partitions. LAPACK's symmetric
solver gives the components, and mean and components (a few numbers a dimension) are broadcast to the projection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.session import Scratch

OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
LOW = (1 << 32) - 1


def integers(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, x): floor(scale * component) as long, for rows whose vector is there with no null or non-finite component.

    Components must stay below 2^62 / scale; a table beyond that is refused when it is read.
    """
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(True)))
    fits = lambda c: F.when(F.abs(c) < float(1 << 62) / scale, F.floor(c * scale)).otherwise(F.raise_error("a component is too large for a long").cast("long"))
    return rows.select("vec_id", F.transform("v", fits).alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _merged(df: DataFrame, part, merge, depth: int = 2):
    """``part`` turns a partition's batches into bytes; ``merge`` adds two of them; null for no rows."""

    def run(batches):
        found = part(batches)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["part"])

    def both(a, b):
        return b if a is None else a if b is None else merge(a, b)

    return df.mapInArrow(run, "part binary").rdd.map(lambda r: bytes(r["part"])).treeAggregate(None, both, both, depth)


def sums(fit: DataFrame, dim: int) -> tuple[int, list[int], int]:
    """Rows, exact sums by dimension, and the largest magnitude. High and low halves are added apart, so nothing overflows."""

    def part(batches):
        total, seen = np.zeros((4, dim), object), False
        for x in _matrices(batches, dim):
            seen = True
            top = max(abs(int(x.max())), abs(int(x.min())))
            total[:3] += np.stack([(x >> 32).sum(axis=0), (x & LOW).sum(axis=0), np.full(dim, len(x))]).astype(object)
            total[3] = np.maximum(total[3], top)
        return ",".join(map(str, total.ravel())).encode() if seen else None

    def read(b):
        return np.array([int(v) for v in b.decode().split(",")], object).reshape(4, dim)

    def merge(a, b):
        a, b = read(a), read(b)
        return ",".join(map(str, np.concatenate([a[:3] + b[:3], np.maximum(a[3:], b[3:])]).ravel())).encode()

    found = _merged(fit, part, merge)
    if found is None:
        return 0, [0] * dim, 0
    high, low, n, top = read(found)
    return int(n[0]), [int(h) * (1 << 32) + int(v) for h, v in zip(high, low, strict=True)], int(top[0])


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean, which is given as its whole part and what is left: large equal parts cancel before they are rounded."""
    return (x - whole).astype(np.float64) - rest


def outer_products(fit: DataFrame, dim: int, mean: tuple[np.ndarray, np.ndarray], turn: np.ndarray) -> np.ndarray:
    """Sum over the rows of the outer product of ``turn`` applied to the centred row; zeros without rows."""
    sc = fit.sparkSession.sparkContext
    sent = sc.broadcast((mean, turn))
    size = turn.shape[1]

    def part(batches):
        (whole, rest), by = sent.value
        total = None
        for x in _matrices(batches, dim):
            z = _centred(x, whole, rest) @ by
            total = z.T @ z if total is None else total + z.T @ z
        return None if total is None else total.tobytes()

    def merge(a, b):
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    found = _merged(fit, part, merge)
    return np.zeros((size, size)) if found is None else np.frombuffer(found).reshape(size, size)


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; those that are rounding only are left out."""
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    real = e > max(e.max(initial=0.0), 0.0) * len(covariance) * 1e-14
    return e[real], u[:, real]


def whiten(df: DataFrame, most: int = 4, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component up to ``most``.

    Entries are scaled to integers, and the fit takes each distinct vector once. Rows whose vector is null, or holds null or
    non-finite entries, drop out; rows that repeat give repeated rows; a null id stays null. Vectors of different lengths are
    fitted apart, a fit a length. Directions without variance have no component, so a length with one distinct vector gives
    no rows, nor do empty vectors or a table without rows. deviation is exact; beyond 38 digits it is null. Columns other
    than id and vector are not read. A matrix of the square of the vectors' length must fit a task.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = integers(df, id_col, vec_col, scale)
    fit = scratch.written(rows.select("x").distinct(), "fit")
    out = None
    for dim in sorted(r[0] for r in fit.select(F.size("x")).distinct().collect()):
        if dim:
            part = _of_dim(rows.filter(F.size("x") == dim), fit.filter(F.size("x") == dim), dim, most)
            out = part if out is None else out.unionByName(part)
    scratch.clear()
    return spark.createDataFrame([], OUT) if out is None else out


def _of_dim(rows: DataFrame, fit: DataFrame, dim: int, most: int) -> DataFrame:
    n, total, top = sums(fit, dim)
    whole = [s // n for s in total]
    mean = np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(total, whole, strict=True)])
    covariance = outer_products(fit, dim, mean, np.eye(dim)) / n
    e, u = components((covariance + covariance.T) / 2, most)
    if not len(e):
        return rows.sparkSession.createDataFrame([], OUT)
    explained = e / np.trace(covariance)
    by = u / np.sqrt(e)
    error = float(np.abs(outer_products(fit, dim, mean, by) / n - np.eye(len(e))).max(initial=0.0))
    sent = rows.sparkSession.sparkContext.broadcast((mean, by, total))
    # n * x - S and the sum of its squares as longs where they surely fit, else as Python's integers.
    narrow = dim * (n * top + max(map(abs, total))) ** 2 < 1 << 62

    def project(batches):
        (whole, rest), by, total = sent.value
        s = np.array(total, np.int64 if narrow else object)
        for batch in batches:
            if not batch.num_rows:
                continue
            (x,) = _matrices([batch], dim)
            z = _centred(x, whole, rest) @ by
            away = (n * (x if narrow else x.astype(object)) - s) ** 2
            k, m = by.shape[1], len(x)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            deviation = pa.array(np.repeat(away.sum(axis=1), k).tolist(), pa.int64()).cast(pa.decimal128(38, 0)) if narrow else pa.array([_decimal(v) for v in np.repeat(away.sum(axis=1), k)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation, pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return rows.mapInArrow(project, OUT)


def _decimal(v: int):
    from decimal import Decimal

    return Decimal(int(v)) if abs(int(v)) < 10**38 else None
