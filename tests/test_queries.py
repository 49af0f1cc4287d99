import shutil

import duckdb
import pytest
from oracle import connect, rows_of_frame, rows_of_sql

import __spark_entry__ as spark_entry
from conftest import SF_DIR
from playlake.operators import skew
from playlake.plans import queries
from playlake.plans.oracles import ORACLES
from playlake.plans.queries import QUERIES
from playlake.scratch import discard


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= spark_entry.queries().items()
    assert ORACLES.items() <= spark_entry.oracle_sql().items()
    assert spark_entry.oracle_sql().keys() <= spark_entry.queries().keys()


def test_session_is_left_as_it_was(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        tables = {t.name for t in spark.catalog.listTables()}
        _, rows = rows_of_frame(QUERIES["fact_plays"](spark, SF_DIR))
        QUERIES["view_counts"](spark, SF_DIR), QUERIES["catalog_counts"](spark, SF_DIR)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
        assert {t.name for t in spark.catalog.listTables()} == tables
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == rows_of_sql(connect(SF_DIR), ORACLES["fact_plays"])[1]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    columns, rows = rows_of_frame(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = rows_of_sql(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["message"]
    assert df.count() == 10


@pytest.mark.parametrize("name", ["fact_plays", "fact_fanout", "top_songs", "etl_song_plays"])
def test_query_equals_oracle_with_every_key_split(spark, duck, monkeypatch, name):
    monkeypatch.setattr(skew, "CELL", 2)
    monkeypatch.setattr(queries, "_RUNS", {})
    _, rows = rows_of_frame(QUERIES[name](spark, SF_DIR))
    assert rows == rows_of_sql(duck, ORACLES[name])[1]


def test_one_run_of_the_job_serves_all_queries_until_the_input_changes(spark, tmp_path, monkeypatch):
    for name in ("orders", "customer", "nation"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path / f"{name}.parquet")
    runs, run = [], queries.job.run
    monkeypatch.setattr(queries.job, "run", lambda *a: runs.append(a) or run(*a))
    plays = QUERIES["etl_song_plays"](spark, str(tmp_path)).count()
    QUERIES["etl_users"](spark, str(tmp_path)), QUERIES["etl_counts"](spark, str(tmp_path))
    assert len(runs) == 1
    duckdb.sql(f"COPY (FROM read_parquet('{SF_DIR}/orders.parquet') LIMIT 700) TO '{tmp_path}/orders.parquet'")
    assert 0 < QUERIES["etl_song_plays"](spark, str(tmp_path)).count() < plays
    assert len(runs) == 2
    discard(spark, runs[1][2])
    QUERIES["etl_users"](spark, str(tmp_path))
    assert len(runs) == 3
