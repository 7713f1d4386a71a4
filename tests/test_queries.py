"""Every registered query against its DuckDB oracle on the smallest tables,
plus the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import VIEWS, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SF}/{v}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "pv"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(entry._q.ORACLE_SQL) == set(entry._q.QUERIES) and set(entry._qp.ORACLE_SQL) == set(entry._qp.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._q.QUERIES | entry._qp.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    want = digest([d[0] for d in res.description], res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["encode_user_log", "land_row_date", "pv_by_hour"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry.queries()[name](spark, SF)
        got = digest(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    res = con.execute(entry.oracle_sql()[name])
    assert got == digest([d[0] for d in res.description], res.fetchall())
