"""Exact nearest representatives without all pairs: pivots, and the triangle inequality on angles.

A few representatives are pivots. Each representative lies in the cell of its nearest pivot, and in a shell of it by its angle
to the pivot; there are at most pivots * shells of these, so their limits travel with the function. An item's angles to the
pivots bound its angle to anything in a shell from below: |angle to the pivot - angle of the shell|. An item first meets the
shell with the lowest bound; what it finds there is a bound from above, and it then meets only shells whose bound is no higher.
Items and representatives of a shell meet in tiles of two bounded blocks, so hot shells are many tasks. Where bounds rule out
too little, an item goes out once a large block of representatives instead of once a shell.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.operators import geometry as geo
from boxlake.operators.sampling import sample_exact
from boxlake.session import Scratch, written

#: Angles of equal rounded cosines differ by less.
TOLERANCE = 4e-6
#: Most rows with their vectors, and most items against a block, that a worker holds at a time beside its input.
SLICE, STRIP = 8192, 256
#: Products added up in another order differ by less, and so do values that are equal when rounded.
NEAR = 2e-12
FOUND = "node long, sim double, rep long, met long"


def usable(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """(name, v): unit vectors as doubles of rows with a key and a vector without null or non-finite components; zero stays zero."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = df.select(F.col(key).cast("long").alias(name), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col(name).isNotNull() & F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(True)))
    return rows.select(name, geo.l2_normalized(F.col("v")).alias("v"))


def _angles(pdf: pd.DataFrame, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(np.stack(pdf["v"].to_numpy()) @ pivots.T, -1, 1))


def _cells(pivots: np.ndarray, width: float):
    """(rep, v, cell, shell, angle)"""

    def run(frames):
        for pdf in frames:
            if len(pdf):
                angles = _angles(pdf, pivots)
                cell = angles.argmin(axis=1)
                angle = angles[np.arange(len(pdf)), cell]
                yield pdf.assign(cell=cell.astype(np.int32), part=(angle / width).astype(np.int32), angle=angle)

    return run


class Shells:
    """Limits of the shells, in order of their number."""

    def __init__(self, pivots: np.ndarray, rows: list) -> None:
        self.pivots = pivots
        self.cell = np.array([r["cell"] for r in rows], np.int64)
        self.low, self.high = (np.array([r[c] for r in rows], np.float64) for c in ("low", "high"))

    def least(self, pdf: pd.DataFrame) -> np.ndarray:
        """(item, shell): no angle to anything in the shell is below."""
        to = _angles(pdf, self.pivots)[:, self.cell]
        return np.maximum(np.maximum(to - self.high, self.low - to), 0)

    def first(self, frames, most: int = 1024):
        """The shell of the lowest bound for each item."""
        for pdf in frames:
            for at in range(0, len(pdf), most):
                part = pdf.iloc[at : at + most]
                yield part[["node", "v"]].assign(shell=self.least(part).argmin(axis=1).astype(np.int32))

    def opened(self, part: pd.DataFrame) -> np.ndarray:
        """(item, shell): whether the shell, not the first one, may hold something nearer than ``sim``."""
        least = self.least(part)
        found = np.arccos(np.clip(part["sim"].to_numpy(), -1, 1))
        open_ = least <= found[:, None] + TOLERANCE
        open_[np.arange(len(part)), least.argmin(axis=1)] = False
        return open_

    def counted(self, frames, most: int = 1024):
        """How many rows ``others`` gives."""
        for pdf in frames:
            yield pd.DataFrame({"n": [sum(int(self.opened(pdf.iloc[at : at + most]).sum()) for at in range(0, len(pdf), most))]})

    def tile(self, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The best of a block of items, from what they found on, among a block of representatives, without shells closed to all of a strip."""
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "sim": [], "rep": [], "met": []})
        y, ids, shell = np.stack(right["v"].to_numpy()), right["rep"].to_numpy(), right["shell"].to_numpy()
        first = np.concatenate([self.least(left.iloc[at : at + 1024]).argmin(axis=1) for at in range(0, len(left), 1024)])
        left = left.iloc[np.argsort(first, kind="stable")]  # so that items of a strip are open to the same shells
        x, best, rep, met = np.stack(left["v"].to_numpy()), left["sim"].to_numpy().copy(), left["rep"].to_numpy().copy(), np.zeros(len(left), np.int64)
        for at in range(0, len(left), STRIP):
            strip = slice(at, at + STRIP)
            some = self.opened(left.iloc[strip]).any(axis=0)[shell]
            near, names = (y, ids) if some.all() else (y[some], ids[some])
            closest(x[strip], near, names, best[strip], rep[strip])
            met[strip] = len(near)
        return pd.DataFrame({"node": left["node"].to_numpy(), "sim": best, "rep": rep, "met": met})

    def others(self, frames, most: int = 1024):
        """Shells that may hold something nearer than what was found in the first one."""
        for pdf in frames:
            for at in range(0, len(pdf), most):
                part = pdf.iloc[at : at + most]
                i, s = np.nonzero(self.opened(part))
                node, v = part["node"].to_numpy(), part["v"].to_numpy()
                # A vector goes out once a shell: in slices, as there may be over a thousand shells.
                for k in range(0, len(i), SLICE):
                    yield pd.DataFrame({"node": node[i[k : k + SLICE]], "v": v[i[k : k + SLICE]], "shell": s[k : k + SLICE].astype(np.int32)})


def _folded(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of row with row to 12 digits, added up component by component as a fold over the arrays does."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * y[:, k]
    return np.round(out, 12) + 0.0


def closest(x: np.ndarray, y: np.ndarray, ids: np.ndarray, best: np.ndarray, rep: np.ndarray) -> None:
    """Raises ``best`` to the highest cosine, to 12 digits, of each row of x with y, and ``rep`` to its id, the smallest of equal ones.

    Blocks are multiplied whole; what comes near the best is added up again in the order of a fold, so places in a block don't matter.
    """
    for at in range(0, len(x), STRIP):
        part, most, of = x[at : at + STRIP], best[at : at + STRIP], rep[at : at + STRIP]
        for k in range(0, len(y), SLICE):
            sims = part @ y[k : k + SLICE].T
            top = sims.max(axis=1)
            rows = np.flatnonzero(top >= most - NEAR)
            i, j = np.nonzero(sims[rows] >= top[rows, None] - NEAR)
            i, j = rows[i], j + k
            for m in range(0, len(i), SLICE):
                a, b = i[m : m + SLICE], j[m : m + SLICE]
                sim = _folded(part[a], y[b])
                order = np.lexsort((ids[b], -sim, a))
                a, b, sim = a[order], b[order], sim[order]
                lead = np.flatnonzero(np.diff(a, prepend=-1))
                a, b, sim = a[lead], b[lead], sim[lead]
                wins = (sim > most[a]) | (sim == most[a]) & (ids[b] < of[a])
                most[a[wins]], of[a[wins]] = sim[wins], ids[b[wins]]


def _best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "sim": [], "rep": [], "met": []})
    best, rep = np.full(len(left), -np.inf), np.zeros(len(left), np.int64)
    closest(np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy()), right["rep"].to_numpy(), best, rep)
    return pd.DataFrame({"node": left["node"].to_numpy(), "sim": best, "rep": rep, "met": len(right)})


def _met(left: DataFrame, reps: DataFrame, sizes: DataFrame, block: int, tile: int) -> DataFrame:
    """(node, sim, rep, met): the best of each tile. left: (node, v, shell), reps: (rep, v, shell), sizes: (shell, size)."""
    asked = left.groupBy("shell").agg(F.count(F.lit(1)).alias("items"))
    # One row a shell.
    cut = F.broadcast(sizes.join(asked, "shell").select("shell", F.ceil(F.col("size") / block).cast("int").alias("subs"), F.ceil(F.col("items") / tile).cast("int").alias("parts")))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(cut, "shell").withColumn("part", deal("node", "parts")).withColumn("sub", every("subs"))
    b = reps.join(cut, "shell").withColumn("sub", deal("rep", "subs")).withColumn("part", every("parts"))
    tiles = ["shell", "part", "sub"]
    return a.select("node", "v", *tiles).groupBy(*tiles).cogroup(b.select("rep", "v", *tiles).groupBy(*tiles)).applyInPandas(_best, FOUND)


def _large_met(left: DataFrame, n: int, reps: DataFrame, r: int, shells: Shells, large: int) -> DataFrame:
    """(node, sim, rep, met): the best of each tile of at most about ``large`` items and as many representatives.

    left: (node, v, sim, rep), n rows; reps: (rep, v, shell), r rows. Vectors go out n * (r / large) + r * (n / large) times,
    however many shells there are; fewer items a tile only where there would be fewer tiles than cores.
    """
    subs = -(-r // large)
    parts = max(-(-n // large), min(-(-left.sparkSession.sparkContext.defaultParallelism // subs), -(-n // 1024)))
    deal = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    a = left.withColumn("part", deal("node", parts)).withColumn("sub", every(subs)).withColumn("tile", F.col("part") * subs + F.col("sub"))
    b = reps.withColumn("sub", deal("rep", subs)).withColumn("part", every(parts)).withColumn("tile", F.col("part") * subs + F.col("sub"))
    spread = lambda df, *c: df.select(*c, "tile").repartition(2 * parts * subs, "tile").groupBy("tile")
    return spread(a, "node", "v", "sim", "rep").cogroup(spread(b, "rep", "v", "shell")).applyInPandas(lambda x, y: shells.tile(x, y), FOUND)


def _all_met(ids: np.ndarray, vectors: np.ndarray, most: int = 1024):
    """Each item against all of a few representatives, which travel with the function, in order of their ids."""

    def run(frames):
        for pdf in frames:
            for at in range(0, len(pdf), most):
                part = pdf.iloc[at : at + most]
                sims = np.round(np.stack(part["v"].to_numpy()) @ vectors.T, 12) + 0.0
                best = sims.argmax(axis=1)  # the first of equal ones, so the smallest
                yield pd.DataFrame({"item": part["item"].to_numpy(), "rep": ids[best], "sim": sims[np.arange(len(part)), best], "met": len(ids)})

    return run


def nearest(items: DataFrame, reps: DataFrame, key: str, vector: str, few: int = 2048, pivots: int = 64, width: float = 0.05, block: int = 16_384, tile: int = 16_384, sends: int = 16, large: int = 65_536, seed: int = 12345) -> DataFrame:
    """(key, rep, sim, met): for each item the representative of highest cosine, rounded to 12 digits; ties go to the smallest.

    met counts the representatives an item was compared with besides the pivots. A zero vector has cosine 0 with all. Rows
    without a key, or whose vector is null or holds null or non-finite components, take no part; repeated rows stay. Without
    representatives there are no rows. At most ``few`` of them, counted first, are sent to every task, and items meet them
    where they are; more meet by pivots. There the work falls with the share of shells that bounds rule out; where angles
    are all alike, as among random vectors, it is all blocks against all blocks, and exact all the same. Items go to the shells
    open to them while that is ``sends`` on average at most, and else to blocks of ``large`` representatives.
    """
    scratch = Scratch(items.sparkSession)
    # Of representatives with one vector only the smallest can be given.
    r = scratch.written(usable(reps, key, vector, "rep").groupBy("v").agg(F.min("rep").alias("rep")).select("rep", "v"), "reps")
    if 0 < r.limit(few + 1).count() <= few:
        known = r.orderBy("rep").collect()  # at most ``few`` rows
        scratch.clear()
        run = _all_met(np.array([k["rep"] for k in known], np.int64), np.array([k["v"] for k in known], np.float64))
        return usable(items, key, vector, "item").mapInPandas(run, "item long, rep long, sim double, met long").withColumnRenamed("item", key)
    some = lambda df: df.filter(F.exists("v", lambda x: x != 0))
    none = lambda df: df.filter(~F.exists("v", lambda x: x != 0))
    lowest = r.agg(F.min("rep").alias("rep"), F.min(F.when(~F.exists("v", lambda x: x != 0), F.col("rep"))).alias("zero")).first()
    rows = scratch.written(usable(items, key, vector, "item").withColumn("node", F.monotonically_increasing_id()), "items")
    named = "item", F.col("rep").cast("long").alias("rep"), F.col("sim").cast("double").alias("sim"), F.col("met").cast("long").alias("met")
    if lowest.rep is None:
        return items.sparkSession.createDataFrame([], f"{key} long, rep long, sim double, met long")
    # Items without a direction have the same cosine with every representative.
    out = none(rows).select("item", F.lit(lowest.rep).alias("rep"), F.lit(0.0).alias("sim"), F.lit(0).alias("met")).select(*named)
    known = sample_exact(some(r), pivots, F.col("rep"), seed).orderBy("rep").collect()  # at most ``pivots`` rows
    if known:
        at = np.array([k["v"] for k in known])
        placed = scratch.written(some(r).mapInPandas(_cells(at, width), "rep long, v array<double>, cell int, part int, angle double"), "cells")
        limits = placed.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("size"), F.min("angle").alias("low"), F.max("angle").alias("high")).orderBy("cell", "part").collect()  # pivots * (pi / width) rows at most
        shells = Shells(at, limits)
        numbers = items.sparkSession.createDataFrame([(r_["cell"], r_["part"], i, r_["size"]) for i, r_ in enumerate(limits)], "cell int, part int, shell int, size long")
        inside = placed.join(F.broadcast(numbers), ["cell", "part"]).select("rep", "v", "shell")
        asks = "node long, v array<double>, shell int"
        first = scratch.written(some(rows).mapInPandas(shells.first, asks), "first")
        found = _met(first, inside, numbers.select("shell", "size"), block, tile)
        found = scratch.written(found.groupBy("node").agg(F.max(F.struct("sim", (-F.col("rep")).alias("rep"))).alias("b"), F.sum("met").alias("met")), "found")
        left = scratch.written(rows.select("node", "v").join(found.select("node", "b.sim", (-F.col("b.rep")).alias("rep")), "node"), "left")
        n = left.count()
        if (left.mapInPandas(shells.counted, "n long").agg(F.sum("n")).first()[0] or 0) <= sends * n:
            others = scratch.written(left.select("node", "v", "sim").mapInPandas(shells.others, asks), "others")
            more = _met(others, inside, numbers.select("shell", "size"), block, tile)
        else:
            more = _large_met(left, n, inside, sum(r_["size"] for r_ in limits), shells, large)
        both = found.select("node", "b", "met").unionByName(more.select("node", F.struct("sim", (-F.col("rep")).alias("rep")).alias("b"), "met"))
        best = both.groupBy("node").agg(F.max("b").alias("b"), F.sum("met").alias("met")).select("node", F.col("b.sim").alias("sim"), (-F.col("b.rep")).alias("rep"), "met")
        if lowest.zero is not None:  # a representative without a direction has cosine 0 with every item
            wins = (F.col("sim") < 0) | (F.col("sim") == 0) & (F.col("rep") > lowest.zero)
            best = best.select("node", F.when(wins, 0.0).otherwise(F.col("sim")).alias("sim"), F.when(wins, lowest.zero).otherwise(F.col("rep")).alias("rep"), "met")
        out = out.unionByName(rows.select("node", "item").join(best, "node").select(*named))
    else:
        out = out.unionByName(some(rows).select("item", F.lit(lowest.rep).alias("rep"), F.lit(0.0).alias("sim"), F.lit(0).alias("met")).select(*named))
    out = written(out.withColumnRenamed("item", key), "nearest")
    scratch.clear()
    return out


def share_computed(found: DataFrame, reps: int) -> float:
    """Pairs of items and representatives that ``nearest`` compared, of all there are."""
    row = found.agg(F.sum("met").alias("met"), F.count(F.lit(1)).alias("n")).first()
    return (row.met or 0) / max(1, row.n * reps) if not math.isnan(row.met or 0) else 0.0
