"""Driver contract: entry smoke run and every query against its SQL oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
from tools.check_oracle import TABLES, _rows

from conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def test_entry_runs(spark):
    df = registry.entry(spark)
    assert df.columns == ["repository", "week", "year", "count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.commit_queries()) == set(registry.commit_oracle_sql())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(registry.commit_queries()))
def test_query_matches_oracle(spark, con, name):
    df = registry.commit_queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(registry.commit_oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(registry.OPERATOR_QUERIES))
def test_query_on_empty_table(spark, name):
    from commitlake.schema import COMMIT

    empty = spark.createDataFrame([], COMMIT)
    rows = registry.OPERATOR_QUERIES[name][1](empty).collect()
    assert rows == ([(0,)] if name == "commit_count" else [])


ZONE_SENSITIVE = ["weekly_commits", "weekday_commits", "commit_gaps", "commit_age", "commit_delay",
                  "commits_by_committer", "load_commits_jsonl"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_query_matches_oracle_in_other_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = registry.commit_queries()[name](spark, SF)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(registry.commit_oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert got == _rows(cols, res.fetchall())
