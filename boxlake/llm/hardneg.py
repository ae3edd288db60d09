"""Hard negatives by bit-sliced integer products.

Vectors are integers, stored once as bit-planes: two's complement, the most significant plane first, a bit a component. The
product of an anchor with a row is the weighted sum of the anchor's products with the row's planes, so after the planes down
to bit j it lies in an interval: what is summed so far, and (2^j - 1) times the anchor's negative or positive components. Each
plane halves the interval. A search asks for the best few scores within limits; a row that is sure to lie within them raises
the score that others must reach, and a row whose interval lies outside the limits, or ends below that score, is dropped.
First planes are matrix products over a block; once few rows are left, the others are computed for these alone, and the
last plane leaves exact scores.

Anchors and rows meet in tiles, a block of one against a block of the other, so that no task holds more than two blocks,
whatever labels or copies a table has; a tile gives back the best few of each search, and a window keeps the best of those.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.session import Scratch, written

NO_LIMIT = (-(1 << 63), (1 << 63) - 1)
FOUND = "anchor long, goal long, node long, vec_id long, score long"
#: Anchors whose scores against a block are held at once.
CHUNK = 64


def sliced(x: np.ndarray, bits: int) -> np.ndarray:
    """(row, plane, byte): planes of two's complement in ``bits`` bits, the most significant first."""
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[:, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2)


def best(score: np.ndarray, vec_id: np.ndarray, node: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores; ties go to the smaller id, then to the row written first."""
    if len(score) > 4 * most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((node[at], vec_id[at], -score[at]))[:most]]


class Search:
    """Searches of a few anchors over the bit-planes of a block of rows."""

    def __init__(self, planes: np.ndarray, dim: int, largest: int, share: float = 0.05) -> None:
        self.rows, self.bits = planes.shape[:2]
        # Sums below 2^52 are exact in doubles, for which there are fast matrix products; beyond, integers do.
        self.kind = np.float64 if dim * largest << self.bits < 1 << 52 else np.int64
        self.planes = [np.unpackbits(planes[:, k], axis=1, count=dim).astype(self.kind) for k in range(self.bits)]
        self.share = share

    def weight(self, k: int) -> int:
        return -(1 << self.bits - 1) if k == 0 else 1 << self.bits - 1 - k

    def tightened(self, s: np.ndarray, rest: int, above: np.ndarray, below: np.ndarray, goals: np.ndarray, most: int, alive: np.ndarray) -> np.ndarray:
        """Rows that may still be among the best of some goal. s: (anchor, row) sums; goals: (anchor, goal, 2) limits."""
        low, high = s + rest * below[:, None], s + rest * above[:, None]
        out = np.zeros(alive.shape, bool)
        for g in range(goals.shape[1]):
            lo, hi = goals[:, g, :1], goals[:, g, 1:]
            sure = alive & (low >= lo) & (high <= hi)
            reach = lo
            if s.shape[1] > most:
                kth = np.partition(np.where(sure, low, _least(low)), s.shape[1] - most, axis=1)[:, [s.shape[1] - most]]
                reach = np.maximum(lo, kth)
            out |= alive & (high >= reach) & (low <= hi)
        return out

    def run(self, a: np.ndarray, goals: np.ndarray, most: int):
        """(anchor, rows that are left, their exact scores) for each anchor of a chunk. goals: (anchor, goal, 2)."""
        a = a.astype(self.kind)
        goals = _limits(goals, self.kind)
        above, below = np.where(a > 0, a, 0).sum(axis=1), np.where(a < 0, a, 0).sum(axis=1)
        s, alive, k = np.zeros((len(a), self.rows), self.kind), np.ones((len(a), self.rows), bool), 0
        while k < self.bits:
            s += self.weight(k) * (a @ self.planes[k].T)
            k += 1
            alive = self.tightened(s, (1 << self.bits - k) - 1, above, below, goals, most, alive)
            if alive.sum() <= self.share * alive.size:
                break
        for i in range(len(a)):
            at = np.flatnonzero(alive[i])
            own, one = s[i, at], slice(i, i + 1)
            for j in range(k, self.bits):
                if not len(at):
                    break
                own = own + self.weight(j) * (self.planes[j][at] @ a[i])
                left = self.tightened(own[None], (1 << self.bits - 1 - j) - 1, above[one], below[one], goals[one], most, np.ones((1, len(at)), bool))[0]
                at, own = at[left], own[left]
            yield i, at, own.astype(np.int64)


def _least(low: np.ndarray):
    return -np.inf if low.dtype == np.float64 else NO_LIMIT[0]


def _limits(goals: np.ndarray, kind: type) -> np.ndarray:
    """Limits as sums have them; those beyond any sum don't limit."""
    if kind is np.int64:
        return goals
    out = goals.astype(np.float64)
    out[goals == NO_LIMIT[0]], out[goals == NO_LIMIT[1]] = -np.inf, np.inf
    return out


def _tile(dim: int, bits: int, largest: int, most: int, same: bool):
    """The best of each search in a tile. Anchors bring goals as pairs of limits; rows are those of the same label, or of others."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 5), np.int64)]
        if len(anchors) and len(rows):
            width = (dim + 7) // 8
            planes = np.frombuffer(b"".join(rows["planes"]) or bytearray(), np.uint8).reshape(len(rows), bits, width)
            label, node, ids = (rows[c].to_numpy() for c in ("label", "node", "vec_id"))
            for own, group in anchors.groupby("label", sort=False):
                at = np.flatnonzero(label == own if same else label != own)
                search = Search(planes[at], dim, largest)
                wide = max(map(len, group["lows"]))
                x = np.stack(group["x"].to_numpy())
                # Searches with fewer goals repeat their last one.
                goals = np.stack([np.stack([np.pad(c, (0, wide - len(c)), mode="edge") for c in pair], axis=1) for pair in zip(group["lows"], group["highs"], strict=True)])
                nodes = group["node"].to_numpy()
                for first in range(0, len(group), CHUNK):
                    chunk = slice(first, first + CHUNK)
                    for i, places, score in search.run(x[chunk], goals[chunk], most):
                        i += first
                        own_rows = at[places]
                        if same:
                            other = node[own_rows] != nodes[i]
                            own_rows, score = own_rows[other], score[other]
                        for lo, hi in dict.fromkeys(map(tuple, goals[i].tolist())):
                            within = np.flatnonzero((score >= lo) & (score <= hi))
                            pick = within[best(score[within], ids[own_rows[within]], node[own_rows[within]], most)]
                            out.append(np.stack([np.full(len(pick), nodes[i]), np.full(len(pick), hi), node[own_rows[pick]], ids[own_rows[pick]], score[pick]], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=[c.split()[0] for c in FOUND.split(", ")])

    return run


def _met(anchors: DataFrame, rows: DataFrame, a_blocks: int, r_blocks: int, run) -> DataFrame:
    """``run`` over each block of anchors and each block of rows; blocks are dealt by a hash of the row's number."""
    deal = lambda n: F.pmod(F.xxhash64("node"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("p", deal(a_blocks)).withColumn("q", every(r_blocks))
    right = rows.withColumn("q", deal(r_blocks)).withColumn("p", every(a_blocks))
    return left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(run, FOUND)


def _leading(found: DataFrame, most: int) -> DataFrame:
    """The best of what the tiles gave for each search: at most ``most`` rows a tile are compared."""
    order = Window.partitionBy("anchor", "goal").orderBy(F.col("score").desc(), "vec_id", "node")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def usable(df: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, label, x): rows with an id, a label and a vector without null or non-finite components, scaled to integers."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(True)))
    fits = lambda c: F.when(F.abs(c) < float(1 << 62) / scale, F.floor(c * scale)).otherwise(F.raise_error("a component is too large for a long").cast("long"))
    return rows.select("vec_id", "label", F.transform("v", fits).alias("x"))


def mine(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_share: int = 80, scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", anchor_block: int = 1024, row_block: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are the other rows of its label that score highest; a positive's negatives are the rows of other
    labels that score highest among those from ``least_share`` per cent of the positive's score up to it. Ties go to the
    smaller id, then to the row written first. ``is_anchor`` is a condition on vec_id and label. Rows without an id or
    label, or whose vector is null or has a null or non-finite component, take no part. Vectors of different lengths never
    meet; empty ones score 0. Rows that share an id are rows of their own, as anchors too. An anchor alone with its label,
    or a positive without negatives in its range, gives no rows; no rows give no rows. Scores must fit a long: a table
    whose vectors might exceed it is refused. Columns other than the three named are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = scratch.written(usable(df, id_col, label_col, vec_col, scale).withColumn("node", F.monotonically_increasing_id()), "integers")
    size = F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))
    out = None
    for r in rows.groupBy(F.size("x").alias("dim")).agg(F.max(size).alias("largest"), F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors")).collect():  # a row a length
        if r["anchors"]:
            part = _of_dim(rows.filter(F.size("x") == r["dim"]), is_anchor, r["dim"], r["largest"] or 0, -(-r["anchors"] // anchor_block), -(-r["n"] // row_block), positives, negatives, least_share, scratch)
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found = written(out, "hard")
    scratch.clear()
    return found


def _of_dim(rows: DataFrame, is_anchor: Column, dim: int, largest: int, a_blocks: int, r_blocks: int, positives: int, negatives: int, least_share: int, scratch: Scratch) -> DataFrame:
    bits = largest.bit_length() + 1
    if dim * largest << bits >= 1 << 62:
        raise ValueError("products of these vectors may not fit a long")

    def slices(frames):
        for pdf in frames:
            if len(pdf):
                planes = sliced(np.stack(pdf["x"].to_numpy()).astype(np.int64).reshape(len(pdf), dim), bits)
                yield pd.DataFrame({"node": pdf["node"], "vec_id": pdf["vec_id"], "label": pdf["label"], "planes": [p.tobytes() for p in planes]})

    planes = scratch.written(rows.mapInPandas(slices, "node long, vec_id long, label long, planes binary"), "planes")
    anchors = rows.filter(is_anchor).select("node", "vec_id", "label", "x")
    free = [F.array(F.lit(v)).alias(n) for n, v in zip(("lows", "highs"), NO_LIMIT, strict=True)]
    # Every row of the label but the anchor itself: one more is asked for, as the anchor may be among the best.
    near = _met(anchors.select("node", "label", "x", *free), planes, a_blocks, r_blocks, _tile(dim, bits, largest, positives + 1, True))
    near = scratch.written(_leading(near, positives).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Positive scores are limits of the next search; those below 0 have an empty range.
    # Hundreds and the rest apart, rounded up: no product exceeds the score itself.
    low = F.expr(f"(positive_score div 100) * {least_share} + ((positive_score % 100) * {least_share} + 99) div 100")
    goals = near.filter("positive_score >= 0").select("anchor", F.col("positive_score").alias("high"), low.alias("low")).distinct()
    # At most ``positives`` goals an anchor.
    goals = goals.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("high", "low"))).alias("g"))
    asked = anchors.join(goals, anchors["node"] == goals["anchor"]).select("node", "label", "x", F.col("g.low").alias("lows"), F.col("g.high").alias("highs"))
    far = _met(asked, planes, a_blocks, r_blocks, _tile(dim, bits, largest, negatives, False))
    far = _leading(far, negatives).select(F.col("anchor").alias("_a"), F.col("goal").alias("_high"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("node").alias("_n"), F.col("vec_id").alias("anchor_id"))
    both = near.join(far, (near["anchor"] == far["_a"]) & (near["positive_score"] == far["_high"])).join(named, F.col("anchor") == F.col("_n"))
    return both.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
