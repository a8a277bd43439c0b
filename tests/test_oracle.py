"""Every registered query against DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemart.plans.queries import all_queries
from tests.compare import connect, difference, duck_rows, spark_rows

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, con, name):
    mine = spark_rows(queries()[name](spark, sf_dir))
    assert difference(mine, duck_rows(con, oracle_sql()[name])) is None


def test_every_query_has_sql():
    assert set(NAMES) <= set(oracle_sql()) and set(NAMES) <= set(queries())


def test_entry_fills_all_hours(spark):
    assert [row.hr for row in entry(spark).collect()] == [f"{h:02d}" for h in range(24)]
