"""Tokens and numbers of label text, with the rules of the tools that wrote it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decimal numbers; single underscores may stand between digits. Non-finite words and suffixes don't count as numbers.
NUMBER = r"^[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?$"
INTEGER = r"^[+-]?[0-9]+(?:_[0-9]+)*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body uses it: a lambda over an array of one."""
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a column that is computed once a row: a generator, which no filter or projection above can copy."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def tokens(line: Column) -> Column:
    """Words between Unicode white space; no empty ones."""
    return F.array_remove(F.split(line, r"(?U)\s+"), "")


def number(token: Column) -> Column:
    """The double that a token spells, else null. Overflow to infinity counts as no number."""
    value = lambda t: F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
    return let(token, lambda t: let(value(t), lambda v: F.when(F.abs(v) < F.lit(float("inf")), v)))


def truncated(token: Column) -> Column:
    """Class ids: any number, cut toward zero; null beyond 32 bits."""
    return number(token).try_cast("int")


def strict_integer(token: Column) -> Column:
    return let(token, lambda t: F.when(t.rlike(INTEGER), F.replace(t, F.lit("_"), F.lit("")).try_cast("int")))


def stem(name: Column) -> Column:
    """File name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(normalized(path), r"([^/]*)$", 1)


def extension(name: Column) -> Column:
    """Lower-cased last extension with its dot, or ''."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))


def normalized(path: Column) -> Column:
    """Forward slashes, no white space around."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^\s+|\s+$", "")


def relative_to(path: Column, root: str) -> Column:
    """The part below ``root``; a path elsewhere stays as it is."""
    top = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(top)), F.substring(path, len(top) + 1, 1 << 30)).otherwise(path)
