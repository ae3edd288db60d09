"""Label, pose, crop-name, review and skeleton text as rows."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.functions import grammar as G


class Variant(Enum):
    """How a reader takes a label line: least and most tokens, class only or whole box, class as number or text."""

    STRICT_COUNT = (5, 5, False, False)
    LENIENT_COUNT = (5, None, False, False)
    LENIENT_BOX = (5, None, True, False)
    STRICT_BOX = (5, 5, True, False)
    CROP_BOX = (5, 5, True, True)


def parse_labels(lines: DataFrame, variant: Variant, line_col: str = "line") -> DataFrame:
    """Input columns plus cls and, where the variant reads boxes, xc, yc, w, h. Lines that don't parse drop out.

    The class is an integer cut toward zero, or the raw token for CROP_BOX. One projection and one filter.
    """
    least, most, box, raw = variant.value
    names = ("xc", "yc", "w", "h") if box else ()

    def read(t: Column) -> Column:
        fields = F.struct((t[0] if raw else G.truncated(t[0])).alias("cls"), *[G.number(t[i]).alias(n) for i, n in enumerate(names, 1)])
        whole = lambda m: F.when(F.greatest(*[m[n].isNull() for n in ("cls", *names)]) if box else m["cls"].isNull(), None).otherwise(m)
        return F.when(F.size(t) >= least if most is None else F.size(t) == least, G.let(fields, whole))

    out = G.once(lines, G.let(G.tokens(F.col(line_col)), read), "_m").filter("_m is not null")
    return out.withColumns({n: F.col(f"_m.{n}") for n in ("cls", *names)}).drop("_m")


def parse_pose(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Input columns plus cls, xc, yc, w, h and kpts, all tokens after the fifth; a line with any bad token drops out."""

    def read(t: Column) -> Column:
        numbers = F.transform(F.slice(t, 2, 1 << 30), G.number)
        both = F.struct(G.truncated(t[0]).alias("cls"), numbers.alias("n"))
        return F.when(F.size(t) >= 5, G.let(both, lambda m: F.when(m["cls"].isNotNull() & ~F.exists(m["n"], lambda x: x.isNull()), m)))

    out = G.once(lines, G.let(G.tokens(F.col(line_col)), read), "_m").filter("_m is not null")
    out = out.withColumns({"cls": F.col("_m.cls"), **{name: F.col("_m.n")[i] for i, name in enumerate(("xc", "yc", "w", "h"))}})
    return out.withColumn("kpts", F.slice("_m.n", 5, 1 << 30)).drop("_m")


def crop_name(base: Column, cls: Column, xc: Column, yc: Column, w: Column, h: Column, ext: str = ".jpg") -> Column:
    """A crop's file name is its record: base, class as written, and four fields of six decimals."""
    return F.format_string("%s_%s_%.6f_%.6f_%.6f_%.6f" + ext, base, cls.cast("string"), xc, yc, w, h)


def decode_crop(names: DataFrame, name_col: str = "crop_name") -> DataFrame:
    """Input columns plus base, cls, xc, yc, w, h of a crop's name or path; all null where it doesn't parse."""

    def read(p: Column) -> Column:
        fields = {name: G.number(F.try_element_at(p, F.lit(k))) for name, k in (("xc", -4), ("yc", -3), ("w", -2), ("h", -1))}
        base = F.array_join(F.slice(p, 1, F.greatest(F.size(p) - 5, F.lit(0))), "_")
        made = F.struct(base.alias("base"), G.truncated(F.try_element_at(p, F.lit(-5))).alias("cls"), *[v.alias(k) for k, v in fields.items()])
        return F.when(F.size(p) >= 6, G.let(made, lambda m: F.when(F.greatest(*[m[c].isNull() for c in ("cls", *fields)]), None).otherwise(m)))

    out = G.once(names, G.let(F.split(G.stem(G.basename(F.col(name_col))), "_"), read), "_m")
    return out.select(names["*"], *[F.col(f"_m.{c}").alias(c) for c in ("base", "cls", "xc", "yc", "w", "h")])


def crop_class(name: Column) -> Column:
    """The strict reading: five parts are enough, and the class is a plain integer."""
    return G.let(F.split(G.stem(G.basename(name)), "_"), lambda p: F.when(F.size(p) >= 5, G.strict_integer(F.try_element_at(p, F.lit(-5)))))


class StatusPolicy(Enum):
    """LOAD: an unknown status is 0. APPLY: only 1 and 2 stay. PURGE: any integer stays."""

    LOAD = "load"
    APPLY = "apply"
    PURGE = "purge"


def parse_reviews(lines: DataFrame, policy: StatusPolicy, line_col: str = "line") -> DataFrame:
    """Input columns plus relkey (forward slashes) and status; lines with under two tokens or no integer drop out."""
    def read(t: Column) -> Column:
        made = F.struct(G.normalized(t[0]).alias("relkey"), G.strict_integer(t[1]).alias("status"))
        return F.when(F.size(t) >= 2, G.let(made, lambda m: F.when(m["status"].isNotNull(), m)))

    out = G.once(lines, G.let(G.tokens(F.col(line_col)), read), "_m").filter("_m is not null")
    out = out.withColumns({"relkey": F.col("_m.relkey"), "status": F.col("_m.status")}).drop("_m")
    if policy is StatusPolicy.LOAD:
        return out.withColumn("status", F.when(F.col("status").isin(0, 1, 2), F.col("status")).otherwise(0))
    return out.filter(F.col("status").isin(1, 2)) if policy is StatusPolicy.APPLY else out


def parse_keypoint_index(files: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(idx, name, comment), after the columns of ``keep``: one row per non-blank line of each file, split at the first '#'."""
    lines = F.filter(F.split(F.col(text_col), r"\r\n|\r|\n"), lambda x: x.rlike(r"(?U)\S"))
    out = files.select(*keep, F.posexplode(lines).alias("idx", "line"))
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return out.select(*keep, "idx", strip(F.split("line", "#", 2)[0]).alias("name"), strip(F.coalesce(F.get(F.split("line", "#", 2), 1), F.lit(""))).alias("comment"))


def parse_skeleton(files: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(ord, n1, n2), after the columns of ``keep``: the pairs ``[a, b]`` anywhere in each file's text, each once, in order of first occurrence."""
    pair = r"\[\s*([^\[\],\s]+)\s*,\s*([^\[\],\s]+)\s*\]"
    found = F.arrays_zip(F.regexp_extract_all(F.col(text_col), F.lit(pair), 1).alias("n1"), F.regexp_extract_all(F.col(text_col), F.lit(pair), 2).alias("n2"))
    return files.select(*keep, F.posexplode(F.array_distinct(found)).alias("ord", "p")).select(*keep, "ord", F.col("p.n1").alias("n1"), F.col("p.n2").alias("n2"))
