"""Every query of the library against its SQL in DuckDB."""

import pytest

from boxlake.plans import folders  # noqa: F401  registers its queries
from boxlake.plans.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    same_rows(QUERIES[name](spark, SF), duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 750
    assert set(e.oracle_sql()) <= set(e.queries())
