"""Annotation views over the star-schema tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxlake.session import table

#: view -> (what it reads, SQL); names in braces are tables or other views.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_images": (("orders",), """
select concat('img_', cast(o_orderkey as string)) as base,
  case substring(o_orderpriority, 1, 1) when '1' then '.jpg' when '2' then '.jpeg' when '3' then '.png' when '4' then '.bmp' else '.webp' end as ext,
  cast(640 + 128 * (o_custkey % 10) as int) as img_w, cast(360 + 72 * (o_custkey % 10) as int) as img_h,
  case when o_orderkey % 10 = 0 then 'missing' when o_orderkey % 10 = 1 and o_orderstatus = 'F' then 'bad' else 'ok' end as state,
  case when o_orderkey % 5 = 4 then 'val' else 'train' end as split
from {orders}"""),
    "v_image_files": (("orders",), """
select concat('img_', cast(o_orderkey as string)) as base, x.ext as ext, x.prio as prio
from {orders} cross join (select '.jpg' as ext, 0 as prio, 1 as m union all select '.jpeg', 1, 2 union all select '.png', 2, 3 union all select '.bmp', 3, 5 union all select '.webp', 4, 7) x
where o_orderkey % 10 <> 0 and (o_custkey % x.m = 0 and x.m > 1 or x.m = 1 and o_orderkey % 2 = 0)"""),
    "v_boxes": (("lineitem",), """
select concat('img_', cast(l_orderkey as string)) as base, cast(l_linenumber % 4 as int) as cls,
  (l_partkey % 1000) / cast(1000 as double) as xc, (l_suppkey % 100) / cast(100 as double) as yc,
  l_quantity / cast(50 as double) as w, l_discount * cast(10 as double) as h, l_orderkey, l_linenumber, l_returnflag
from {lineitem}"""),
    "v_label_lines": (("v_boxes",), """
select base, concat(case when l_orderkey % 17 = 0 then 'abc' when l_orderkey % 3 = 0 then concat(cast(cls as string), '.0') else cast(cls as string) end,
  ' ', printf('%.6f', xc), ' ', printf('%.6f', yc), ' ', printf('%.6f', w),
  case when l_orderkey % 11 = 0 then '' else concat(' ', printf('%.6f', h)) end,
  case when l_orderkey % 13 = 0 then ' 0.500000 0.500000 2' else '' end) as line
from {v_boxes}"""),
    "v_crops": (("v_boxes",), """
select base, concat(base, '_', cast(cls as string), '_', printf('%.6f', xc), '_', printf('%.6f', yc), '_', printf('%.6f', w), '_', printf('%.6f', h), '.jpg') as crop_name,
  case l_returnflag when 'A' then 'O_Person' when 'N' then 'O_Vehicle' else 'O_Bike' end as pred_dir,
  case (l_orderkey + l_linenumber) % 5 when 0 then 1 when 1 then 2 else 0 end as status
from {v_boxes} where w > 0 and h > 0"""),
    "v_review_lines": (("v_crops",), """
select concat(pred_dir, case when length(crop_name) % 2 = 0 then '/' else chr(92) end, crop_name, ' ',
  case when length(crop_name) % 7 = 0 then 'x' when length(crop_name) % 7 = 1 then '9' else cast(status as string) end) as line
from {v_crops}"""),
    "v_pose": (("lineitem",), """
select concat('img_', cast(l_orderkey as string)) as base, cast(l_linenumber - 1 as int) as kpt_idx,
  max((l_partkey % 1000) / cast(1000 as double)) as kx, max((l_suppkey % 100) / cast(100 as double)) as ky, max(cast(l_partkey % 3 as int)) as v
from {lineitem} group by l_orderkey, l_linenumber"""),
    "v_prep": (("embeddings",), """
select vec_id, transform(transform(embedding, x -> cast(x as double)), x -> if(x > aggregate(transform(embedding, y -> cast(y as double)), 0D, (a, b) -> a + b) / 64D, 1, 0)) as ahash,
  transform(transform(embedding, x -> cast(x as double)), x -> if(x > 0D, 1, 0)) as phash, embedding
from {embeddings}"""),
}
DUCK_PREP = """
select vec_id, list_transform(embedding::double[], lambda x: case when x > list_sum(embedding::double[]) / 64 then 1 else 0 end) as ahash,
  list_transform(embedding::double[], lambda x: case when x > 0 then 1 else 0 end) as phash, embedding
from {embeddings}"""


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, or a view over tables, as a DataFrame; nothing is registered."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    reads, sql = VIEWS[name]
    return spark.sql(sql, **{r: view(spark, sf_dir, r) for r in reads})


def duck(sql: str, *names: str) -> str:
    """The SQL after ``with`` clauses for the views it names, in order of what they read."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for r in VIEWS[name][0]:
                add(r)
            order.append(name)

    for n in names:
        add(n)
    bodies = {n: (DUCK_PREP if n == "v_prep" else VIEWS[n][1]).replace("{", "").replace("}", "") for n in order}
    ctes = ",\n".join(f"{n} as ({bodies[n]})" for n in order)
    rest = sql.strip()
    if rest.startswith("with recursive "):
        return f"with recursive {ctes},\n{rest[15:]}" if ctes else rest
    if rest.startswith("with "):
        return f"with {ctes},\n{rest[5:]}" if ctes else rest
    return f"with {ctes}\n{rest}" if ctes else rest
