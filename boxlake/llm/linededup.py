"""Boilerplate lines by site-relative frequency: pages of a host that contain a line, divided by the host's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import free_names, let
from boxlake.session import size_bytes, written

#: Broadcast the boilerplate table up to this size; beyond it documents and lines meet by a shuffle on the host.
BROADCAST_BYTES = 8 << 20


def _key(line: Column) -> Column:
    """96 bits of hash of a line without surrounding spaces, as text: Spark tells texts apart by hash tables, structs by pairs."""
    return let(F.trim(line), lambda t: F.concat(F.hex(F.xxhash64(t)), F.lit(":"), F.hex(F.hash(t))))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.hash(key), buckets)


def boilerplate(docs: DataFrame, ratio: float, least_pages: int, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(host, lines): for each host with any, the keys of lines on more than ``ratio`` of its pages and on ``least_pages`` at least.

    lines is a hash table: an array of buckets of about eight keys each, so that a line is looked up in one bucket however
    many there are. A page counts once for a line however often it holds it. Counts are combined before the shuffle; a
    host's keys stay below its mean number of lines a page divided by ``ratio``.
    """
    pages = docs.select(F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(text_col).alias("text"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), _key))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    common = written(counts.join(totals, "host").filter(F.col("n") > ratio * F.col("pages")).select("host", "line"), "common")
    sizes = common.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / 8).cast("int").alias("buckets"))
    every = sizes.select("host", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("b"), F.array().cast("array<string>").alias("keys"))
    own = common.join(sizes, "host").select("host", _bucket(F.col("line"), F.col("buckets")).alias("b"), F.array("line").alias("keys"))
    filled = every.unionByName(own).groupBy("host", "b").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    return filled.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "keys"))), lambda x: x["keys"]).alias("lines"))


def drop_boilerplate(docs: DataFrame, ratio: float = 0.1, least_pages: int = 3, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without boilerplate lines, and _n_lines, _n_dropped (instead of such columns of its own).

    The ratio decides, whatever the host's size; ``least_pages`` only asks for repetition, as on a host of a few pages each
    line exceeds the ratio, and two pages agree where one is the other's copy. Lines are what line feeds separate; lines of
    spaces alone are never boilerplate and stay. A null host counts as ''. Time is linear in the text's length. Null texts stay null with no lines, empty ones stay empty; a text of boilerplate alone becomes ''. Repeated rows count as
    pages of their own. Documents are not moved unless the boilerplate table outgrows a broadcast.
    """
    host, lines_of, made_ = free_names(docs, "_host", "_lines", "_made")
    found = written(boilerplate(docs, ratio, least_pages, host_col, text_col), "boilerplate").select(F.col("host").alias(host), F.col("lines").alias(lines_of))
    if size_bytes(found) <= BROADCAST_BYTES:
        found = F.broadcast(found)
    rows = docs.join(found, F.coalesce(docs[host_col], F.lit("")) == F.col(host), "left")

    def held(key: Column) -> Column:
        return F.array_contains(F.get(F.col(lines_of), _bucket(key, F.size(lines_of))), key)

    def clean(lines: Column) -> Column:
        kept = F.when(F.col(lines_of).isNull(), lines).otherwise(F.filter(lines, lambda x: (F.trim(x) == "") | ~let(_key(x), held)))
        return let(kept, lambda k: F.struct(F.array_join(k, "\n").alias("text"), F.size(lines).cast("long").alias("n"), (F.size(lines) - F.size(k)).cast("long").alias("dropped")))

    rows = rows.withColumn(made_, F.when(F.col(text_col).isNotNull(), let(F.split(F.col(text_col), "\n"), clean)))
    columns = [F.col(f"{made_}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("_n_lines", "_n_dropped")]
    return rows.select(*columns, F.coalesce(F.col(f"{made_}.n"), F.lit(0)).alias("_n_lines"), F.coalesce(F.col(f"{made_}.dropped"), F.lit(0)).alias("_n_dropped"))
