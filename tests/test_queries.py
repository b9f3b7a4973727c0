"""Every query with SQL gives DuckDB's rows, in any session time zone."""

import os

import pytest

from driftwell import queries_sources, queries_tables  # noqa: F401  add to the catalogue
from driftwell.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        df = QUERIES[name](spark, DATA)
        got = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got
    if name in ORACLES:
        result = duck.sql(ORACLES[name])
        at = sorted(range(len(result.columns)), key=result.columns.__getitem__)
        assert sorted(df.columns) == sorted(result.columns)
        assert got == sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall())


def test_all_but_a_few_have_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["user_id", "event_type"]


def test_times_in_milliseconds_of_all_rows(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    got = QUERIES["timestamp_ms"](spark, DATA)
    assert got.join(events, "event_id").count() == got.count() == events.count()
