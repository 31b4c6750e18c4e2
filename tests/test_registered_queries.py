"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect
from star_oracle import SQL
from tallyspan.plans.star_queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.columns[:4] == ["geo_code", "geo_name", "geo_level", "year"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, sql.execute(SQL[name]).df()) == ""
