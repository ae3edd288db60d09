"""Queries over folders of files that tasks write from the tables: listings, label lines, rewritten labels, file actions.

A label file for each supplier, in a folder for its nation, holds a line for each of its boxes; every tenth supplier's file
is empty. Files lie in a new folder below the shared one, so a query can be repeated; nothing of them is kept in the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import grammar as G
from boxlake.operators import parse
from boxlake.plans.fixtures import table
from boxlake.plans.queries import query
from boxlake.session import shared_dir
from boxlake.sources import files, sinks

_LINES = """n as (select 'n' || (s_nationkey % 5) || '/n' || s_nationkey || '/s' || s_suppkey || '.txt' as name, 's' || s_suppkey as base, s_suppkey from supplier),
l as (select name, base, s_suppkey, cast(l_linenumber % 4 as integer) as cls, l_orderkey, l_linenumber, (l_linenumber % 4) || ' ' || printf('%.6f', (l_partkey % 1000) / cast(1000 as double)) || ' ' || printf('%.6f', (l_orderkey % 100) / cast(100 as double)) || ' ' || printf('%.6f', l_quantity / cast(50 as double)) || ' ' || printf('%.6f', l_discount * cast(10 as double)) as line
  from n join lineitem on l_suppkey = s_suppkey where s_suppkey % 10 <> 0),
z as (select n.name, n.base, n.s_suppkey, cast(coalesce(sum(length(line) + 1), 0) as bigint) as size from n left join l on n.s_suppkey = l.s_suppkey group by 1, 2, 3)"""


def _names(s: SparkSession, d: str) -> DataFrame:
    nation = F.col("s_nationkey")
    name = F.concat(F.lit("n"), nation % 5, F.lit("/n"), nation, F.lit("/s"), "s_suppkey", F.lit(".txt"))
    return table(s, d, "supplier").select(name.alias("name"), F.concat(F.lit("s"), "s_suppkey").alias("base"), "s_suppkey")


def _texts(s: SparkSession, d: str) -> DataFrame:
    """(name, content): the files. An array holds one file's lines."""
    fields = [F.col("l_linenumber") % 4, *[F.format_string("%.6f", c) for c in ((F.col("l_partkey") % 1000) / 1000, (F.col("l_orderkey") % 100) / 100, F.col("l_quantity").cast("double") / 50, F.col("l_discount").cast("double") * 10)]]
    rows = table(s, d, "lineitem").filter(F.col("l_suppkey") % 10 != 0).select(F.col("l_suppkey").alias("s_suppkey"), F.struct("l_orderkey", "l_linenumber", F.concat_ws(" ", *fields).alias("line")).alias("l"))
    own = rows.groupBy("s_suppkey").agg(F.sort_array(F.collect_list("l")).alias("own"))
    text = F.coalesce(F.concat(F.array_join(F.transform("own", lambda x: x["line"]), "\n"), F.lit("\n")), F.lit(""))
    return _names(s, d).join(own, "s_suppkey", "left").select("name", text.alias("content"))


def _folder(s: SparkSession, d: str) -> str:
    """A new folder with all files."""
    root = f"{shared_dir(s)}/files-{uuid.uuid4().hex}"
    sinks.write_files(_texts(s, d), root)
    return root


def _below(s: SparkSession, root: str):
    return G.relative_to(F.col("path"), files.qualified(s, root))


@query(f"with {_LINES} select name, size, base, '.txt' as ext from z")
def label_files(s, d):
    root = _folder(s, d)
    return files.listing(s, root, recursive=True, kind="label").select(_below(s, root).alias("name"), "size", "base", "ext")


@query(f"with {_LINES} select regexp_extract(name, 'n[0-9]+/(n[0-9]+)/', 1) as folder, cls, count(*) as n from l group by 1, 2")
def label_file_classes(s, d):
    root = _folder(s, d)
    boxes = parse.parse_labels(files.label_lines(s, root, recursive=True), parse.Variant.LENIENT_BOX)
    return boxes.groupBy(F.regexp_extract("dir", "([^/]*)$", 1).alias("folder"), "cls").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_LINES}, g as (select distinct l_orderkey, l_linenumber, s_suppkey from l where cls = 1), k as (select distinct s_suppkey from g) select z.base || '.txt' as name, cast((select coalesce(sum(length(line) + 1), 0) from l where l.s_suppkey = z.s_suppkey and cls <> 1) as bigint) as size from z join k on k.s_suppkey = z.s_suppkey")
def rewritten_label_files(s, d):
    root = _folder(s, d)
    # By folder, as a glob of files has Spark ask for each of them by itself.
    texts = files.whole_text(s, f"{root}/*/*").select(G.stem(G.basename(F.col("path"))).alias("base"), "text")
    # Small files are many small splits; a few tasks a core write them.
    texts = texts.coalesce(4 * s.sparkContext.defaultParallelism)
    sinks.write_labels(sinks.rewritten_files(texts, lambda line: ~line.startswith("1 ")), f"{root}/out")
    return files.listing(s, f"{root}/out").select("name", "size")


@query(
    f"""with {_LINES} select name, case s_suppkey % 3 when 0 then 'delete' when 1 then 'move' else 'copy' end as op, 'ok' as result, case when s_suppkey % 3 > 0 then size end as size from z
union all select name || '.lost', 'delete', 'gone', null from n where s_suppkey % 4 = 0"""
)
def file_actions(s, d):
    root = _folder(s, d)
    k = F.col("s_suppkey") % 3
    op = F.when(k == 0, "delete").when(k == 1, "move").otherwise("copy")
    names = _names(s, d)
    plan = names.select(F.col("name").alias("relkey"), op.alias("op"), F.when(k > 0, F.concat(F.lit("to/"), "name")).alias("dst"))
    lost = names.filter("s_suppkey % 4 = 0").select(F.concat("name", F.lit(".lost")).alias("relkey"), F.lit("delete").alias("op"), F.lit(None).cast("string").alias("dst"))
    done = sinks.apply_actions(sinks.actions(plan.unionByName(lost), f"{root}/", f"{root}/"), dry_run=False)
    there = files.listing(s, f"{root}/to", recursive=True).select(_below(s, f"{root}/to").alias("name"), "size")
    return done.select(F.expr(f"substring(src, {len(root) + 2})").alias("name"), "op", "result").join(there, "name", "left")
