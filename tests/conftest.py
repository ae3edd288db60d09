from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


SF = "/root/testdata/sf0.001"


def norm(v):
    """Comparable text of a value from Spark or DuckDB."""
    if isinstance(v, float):
        return repr(float(f"{v:.9g}"))
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return norm(list(v.asDict().values())) if hasattr(v, "asDict") else str(v)


def same_rows(spark_df, duck_con, sql: str) -> None:
    names = sorted(spark_df.columns)
    got = sorted(str([norm(r[c]) for c in names]) for r in spark_df.collect())
    res = duck_con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == names
    want = sorted(str([norm(r[cols.index(c)]) for c in names]) for r in res.fetchall())
    assert got == want
