"""The driver contract, and every query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["text_representation", "timestamp", "label", "source_file"]
    assert df.count() == 1000


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    import re
    without = set(E.queries()) - set(E.oracle_sql())
    assert {n for n in without if not re.match(r"op\d+_|pipeline$", n)} == set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


@pytest.mark.parametrize("name", ["featurize", "featurize_typed"])
def test_scale_featurize_sf01(spark, name):
    """The flagship query (both routes) on sf0.1, 100,000 records, against its oracle."""
    sf = "/root/testdata/sf0.1"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    res = c.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert len(rows) == len(orows) == 100_000
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


@pytest.mark.parametrize("name", ["featurize", "featurize_typed", "iso_epoch", "record_text_wide"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert digest(rows, df.columns)[0] == digest(res.fetchall(), ocols)[0]


@pytest.mark.parametrize("name", ["featurize", "row_errors", "first_timestamp", "safe_name", "record_text_wide"])
def test_results_do_not_depend_on_ansi_mode(spark, con, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert digest(rows, df.columns)[0] == digest(res.fetchall(), ocols)[0]
