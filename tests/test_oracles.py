"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest

from __spark_entry__ import entry
from tools.check import connect, duck_rows, sort_key, spark_rows, types
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = connect("/root/testdata/sf0.001")
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df, sql = QUERIES[name](spark, sf_dir), ORACLES[name]
    columns, rows = spark_rows(df)
    want_columns, want = duck_rows(duck, sql)
    assert columns == want_columns
    assert sorted(rows, key=sort_key) == sorted(want, key=sort_key)
    assert types(duck, sql, df) == []


def test_entry_is_revenue_by_month(spark):
    assert entry(spark).columns == ["year", "month", "total_trips", "total_amount_received"]
