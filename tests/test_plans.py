"""Physical plans: what reaches the scans, what is shuffled, and that no Python runs per row."""

from itertools import groupby

import pytest
from pyspark.sql import functions as F

import star
from conftest import SF_DIR, play, song
from playlake.operators import dims, fact, reports
from playlake.plans import job
from playlake.plans.queries import QUERIES
from playlake.plans.standins import LinearStar
from playlake.sources.json_inputs import read_activity_log


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dim_time", "fact_plays", "top_songs", "free_paid_ratio", "json_scan"])
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text


def test_page_filter_and_columns_reach_the_json_scan(spark, inputs):
    inputs.log(play())
    users = dims.users_dim(dims.filter_page(read_activity_log(spark, str(inputs)), "NextSong"))
    text = plan(users)
    assert "PushedFilters: [IsNotNull(page), EqualTo(page,NextSong)]" in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "userId" in schema and "song" not in schema


def test_page_filter_reaches_the_parquet_scan(spark):
    assert "EqualTo(event_type,purchase)" in plan(QUERIES["filter_page"](spark, SF_DIR))


def test_each_raw_input_is_scanned_once(spark, inputs, tmp_path, monkeypatch):
    reads = []
    for name in ("read_song_metadata", "read_activity_log"):
        read = getattr(job, name)
        monkeypatch.setattr(job, name, lambda *a, name=name, read=read: reads.append(name) or read(*a))
    inputs.songs(song()).log(play())
    written = []
    monkeypatch.setattr(job, "stage", lambda df, path, stage=job.stage: written.append(plan(df)) or stage(df, path))
    job.run(spark, str(inputs), f"{tmp_path}/out")
    assert sorted(reads) == ["read_activity_log", "read_song_metadata"]
    assert sum(text.count("Scan json") for text in written) == 2


def test_only_the_top_rows_are_broadcast_by_hint(spark, inputs):
    inputs.songs(song()).log(play())
    built = star.build(spark, inputs)
    logical = reports.top_artists(built.song_plays, built.songs, built.artists)
    text = logical._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("strategy=broadcast") == 2
    assert "GlobalLimit 10" in text


def test_time_is_distinct_on_ts_alone(spark, inputs):
    inputs.log(play())
    text = plan(dims.time_dim(dims.filter_page(read_activity_log(spark, str(inputs)), "NextSong")))
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "hashpartitioning(ts" in shuffled[0]


def test_pairs_are_counted_before_the_shuffle(spark):
    plays = spark.range(10).select(F.lit("s").alias("song"), F.lit("a").alias("artist"))
    text = plan(fact.count_pairs(plays))
    before, after = text.split("Exchange hashpartitioning")
    assert "partial_count" in after and "partial_count" not in before


def test_plays_of_a_pair_stand_side_by_side_in_the_fact(spark, tmp_path):
    # The matches are small enough to be broadcast, which would leave the plays in the order of the log.
    plays = spark.range(20_000).select(
        F.timestamp_seconds("id").alias("start_time"),
        F.concat(F.lit("T"), F.col("id") % 20).alias("song"),
        F.lit("N").alias("artist"),
        F.col("id").cast("string").alias("userId"),
        *[F.lit("x").alias(c) for c in ("level", "location")],
        F.lit(1).alias("sessionId"),
        F.concat(F.lit("T"), F.col("id") % 20).alias("userAgent"),
        F.col("id").alias("play_no"),
    )
    songs = spark.range(100).select(
        F.col("id").cast("string").alias("song_id"),
        F.concat(F.lit("T"), F.col("id") % 20).alias("title"),
        *[F.lit("x").alias(c) for c in ("artist_id", "year", "duration")],
    )
    artists = spark.range(1).select(F.lit("N").alias("name"))
    plays, pairs = job.stage(plays, f"{tmp_path}/plays"), job.stage(fact.count_pairs(plays), f"{tmp_path}/pairs")
    matches = job.stage(fact.match_pairs(pairs, songs, artists), f"{tmp_path}/matches")
    rows = fact.build_fact(plays, matches, ["play_no"], pairs)
    found = rows.select(F.spark_partition_id().alias("task"), F.col("user_agent").alias("title")).collect()
    assert len(found) == 100_000
    assert len(list(groupby(found, key=lambda row: (row["task"], row["title"])))) == 20


def test_log_lines_are_made_after_their_shuffles(spark):
    lines = LinearStar(spark, SF_DIR).all_lines
    text = lines._jdf.queryExecution().optimizedPlan().toString()
    made, shuffled = text.split("RebalancePartitions")
    assert "customer " in made
    assert "customer " not in shuffled and "o_totalprice" not in shuffled.split("Relation")[0]
