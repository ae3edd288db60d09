"""Connected components as alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.session import checkpointed


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"), F.expr("sum(cast(v as decimal(38,0)))").alias("s")).first()
    return tuple(row)


def _union_find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of the edges of one task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for pdf in frames:
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 65_536):
        part = nodes[at : at + 65_536]
        yield pd.DataFrame({"node": part, "component": [find(x) for x in part]})


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60, task_edges: int = 200_000) -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node id reachable.

    Self loops, repeated and null edges are ignored. Each round is cut by a reliable checkpoint; the loop ends when the
    edge set is a star forest that no longer changes, and fails loudly if it does not end within ``max_rounds``. An edge set
    of at most ``task_edges`` distinct edges, counted first, is one small task's work instead. Ids are 64-bit integers.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v")
    e = checkpointed(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.count() <= task_edges:
        return checkpointed(e.coalesce(1).mapInPandas(_union_find, "node long, component long"))
    before = _state(e)
    for _ in range(max_rounds):
        e = checkpointed(_small_star(_large_star(e)).distinct())
        after = _state(e)
        if after == before:
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        before = after
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
