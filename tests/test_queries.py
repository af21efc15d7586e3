"""Every query with SQL agrees with it on the smallest tables; the others run."""

import duckdb  # noqa: F401
import pytest

from corvane import queries
from tests.oracle import compare

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    compare(spark, DIR, name, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries())
