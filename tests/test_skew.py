"""The split join must give exactly what a plain join gives, whichever side the hot key is on."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from playlake.operators import fact, skew


def frame(spark, prefix, counts):
    """`counts[key]` rows of each key, told apart by their number; None is a NULL key."""
    rows = [(key, f"{prefix}{i}") for key, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, f"key STRING, {prefix} STRING")


SIDES = [
    ({"hot": 300, "a": 3, "b": 1, None: 50}, {"hot": 1, "a": 2, "c": 5, None: 50}),
    ({"hot": 2, "a": 3}, {"hot": 400, "a": 2}),
    ({"hot": 90, "warm": 40, "a": 1}, {"hot": 80, "warm": 30, "a": 1}),
    ({"a": 1}, {"b": 1}),
]


@pytest.mark.parametrize("left_counts, right_counts", SIDES)
def test_split_join_equals_plain_join(spark, left_counts, right_counts):
    left, right = frame(spark, "l", left_counts), frame(spark, "r", right_counts)
    sizes = skew.key_sizes(left, right, ["key"])
    split = skew.split_join(left, right, ["key"], ["l"], ["r"], sizes, cell=10)
    got = Counter(tuple(r) for r in split.select("key", "l", "r").collect())
    assert got == Counter(tuple(r) for r in left.join(right, "key").select("key", "l", "r").collect())
    assert all(n == 1 for n in got.values())


def totals_of(left, right):
    sizes = skew.key_sizes(left, right, ["key"])
    return sizes.exact(None), {"left_rows": sizes.left.rows, "right_rows": sizes.right.rows, "output_rows": sizes.output()}


def hash_of(spark, *keys):
    rows = spark.createDataFrame([(k,) for k in keys], "key STRING").select("key", skew.key_hash(["key"]).alias("h")).collect()
    return {r["h"]: r["key"] for r in rows}


def test_large_output_sets_the_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    left, right = frame(spark, "l", {"hot": 90, "a": 3}), frame(spark, "r", {"hot": 80, "a": 2})
    split = skew.split_join(left, right, ["key"], ["l"], ["r"], skew.key_sizes(left, right, ["key"]), cell=10)
    assert "72" in split._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    got = Counter(tuple(r) for r in split.select("key", "l", "r").collect())
    assert got == Counter(tuple(r) for r in left.join(right, "key").select("key", "l", "r").collect())


def test_empty_sides(spark):
    left, right = frame(spark, "l", {}), frame(spark, "r", {})
    assert skew.split_join(left, right, ["key"], ["l"], ["r"], skew.key_sizes(left, right, ["key"])).count() == 0


def test_no_hot_key_gives_a_plain_join(spark):
    left, right = frame(spark, "l", {"a": 3}), frame(spark, "r", {"a": 2})
    joined = skew.split_join(left, right, ["key"], ["l"], ["r"], skew.key_sizes(left, right, ["key"]))
    assert joined.columns == ["key", "l", "r"]
    assert "explode" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_one_task_gets_at_most_a_cell(spark):
    """A key with a third of all rows on both sides is spread evenly."""
    left, right = frame(spark, "l", {"hot": 400, "a": 2}), frame(spark, "r", {"hot": 200, "a": 2})
    hot = skew._hot_keys(*insert(10, totals_of(left, right)))
    rows = [(r["key_hash"], r["left_slices"], r["right_slices"]) for r in hot.collect()]
    assert rows == [(next(iter(hash_of(spark, "hot"))), 40, 20)]
    sliced = skew._sliced(left, hot, ["key"], ["l"], "left", "right", True)
    per_slice = sliced.where("key = 'hot'").groupBy("left_slice", "right_slice").count()
    assert per_slice.agg(F.max("count")).first()[0] <= 25
    assert sliced.where("key = 'hot'").count() == 400 * 20


def insert(cell, sizes_and_totals):
    sizes, totals = sizes_and_totals
    return sizes, cell, totals


def share_of_largest_task(df, keys):
    """Rows of the largest group of a task's size, if rows are dealt by `keys`."""
    sizes = [r["count"] for r in df.groupBy(*keys).count().collect()]
    return max(sizes, default=0) / max(1, sum(sizes))


@pytest.mark.parametrize("task_rows", [10**9, 100])
@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_keys_without_a_match_are_not_shuffled(spark, monkeypatch, task_rows, hot_side):
    """Half of all rows on one side are of a key that the other side lacks."""
    monkeypatch.setattr(skew, "TASK_ROWS", task_rows)
    many = {"hot": 3000} | {f"k{i}": 10 for i in range(300)}
    few = {f"k{i}": 10 for i in range(300)}
    counts = (many, few) if hot_side == "left" else (few, many)
    left, right = frame(spark, "l", counts[0]), frame(spark, "r", counts[1])
    sliced = []
    cut = skew._sliced
    monkeypatch.setattr(skew, "_sliced", lambda *a, **k: sliced.append(cut(*a, **k)) or sliced[-1])
    joined = skew.split_join(left, right, ["key"], ["l"], ["r"], skew.key_sizes(left, right, ["key"]), cell=10)
    assert joined.count() == 300 * 100
    assert len(sliced) == 2
    for side in sliced:
        assert side.where("key = 'hot'").count() == 0
        assert share_of_largest_task(side, ["key", "left_slice", "right_slice"]) < 0.05


def test_hot_key_with_few_partners_is_spread(spark):
    left, right = frame(spark, "l", {"hot": 3000} | {f"k{i}": 10 for i in range(300)}), frame(spark, "r", {"hot": 1})
    hot = skew._hot_keys(*insert(10, totals_of(left, right)))
    sliced = skew._sliced(left, hot, ["key"], ["l"], "left", "right", False)
    assert share_of_largest_task(sliced, ["key", "left_slice", "right_slice"]) < 0.02


def test_number_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_HOT", 15_000)
    sizes = spark.range(20_000).selectExpr("id AS key_hash", "id + 101 AS left_rows", "1L AS right_rows")
    totals = {c: sizes.agg(F.sum(c)).first()[0] for c in ("left_rows", "right_rows")}
    totals["output_rows"] = totals["left_rows"]
    assert 0 < skew._hot_keys(sizes, 10, totals).count() <= 3 * skew.MAX_HOT
    assert skew._hot_keys(sizes, 10, dict.fromkeys(totals, 0)).count() == 20_000
    # No text of a key comes to the driver.
    assert set(skew._hot_keys(sizes, 10, totals).schema.simpleString()[7:-1].split(",")) == {
        "key_hash:bigint", "matched:boolean", "left_slices:bigint", "right_slices:bigint"
    }


def test_many_medium_keys(spark, monkeypatch):
    """Two thousand keys of 0.05 % of the rows each: slices follow the rows of a task, not the share."""
    for task_rows in (4000, 1000):
        monkeypatch.setattr(skew, "TASK_ROWS", task_rows)
        left = spark.range(200_000).selectExpr("CAST(id % 2000 AS STRING) AS key", "id AS l")
        right = spark.range(2000).selectExpr("CAST(id AS STRING) AS key", "id AS r")
        cell = skew.isqrt(task_rows // skew.PIECES_PER_TASK)
        joined = skew.split_join(left, right, ["key"], ["l"], ["r"], skew.key_sizes(left, right, ["key"]), cell=cell)
        assert ("key_hash" in joined._jdf.queryExecution().optimizedPlan().toString()) == (task_rows == 1000)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            per_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sum(r["n"] for r in per_task) == 200_000
        assert max(r["n"] for r in per_task) <= 2 * task_rows


def test_keys_are_not_counted_if_none_can_be_hot(spark, monkeypatch):
    counted = []
    exact = skew.KeySizes.exact
    monkeypatch.setattr(skew.KeySizes, "exact", lambda self, only: counted.append(only) or exact(self, only))
    left, right = frame(spark, "l", {f"k{i}": 5 for i in range(50)}), frame(spark, "r", {f"k{i}": 4 for i in range(60)})
    sizes = skew.key_sizes(left, right, ["key"])
    assert (sizes.left.rows, sizes.left.rest, round(sizes.output())) == (250, 0, 1000)
    assert skew.split_join(left, right, ["key"], ["l"], ["r"], sizes, cell=10).count() == 1000
    assert counted == []
    # One key is suspect, and only this one is counted.
    hotter = left.unionAll(left.where("key = 'k7'")).unionAll(frame(spark, "l", {"k7": 90}))
    sizes = skew.key_sizes(hotter, right, ["key"])
    assert skew.split_join(hotter, right, ["key"], ["l"], ["r"], sizes, cell=10).count() == 1000 + 95 * 4
    assert [{hash_of(spark, "k7").get(k) for k in only} for only in counted] == [{"k7"}]


def test_a_sketch_that_overflows_bounds_all_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "TRACKED", 64)
    monkeypatch.setattr(skew, "FREQUENT", 20)
    counts = {f"k{i}": 2 for i in range(2000)} | {"hot": 2500, "warm": 1500}
    left = frame(spark, "l", counts).repartition(7)
    [seen] = skew.summarise(left, ["key"])
    names = hash_of(spark, *counts)
    assert seen.rows == 8000 and 1000 < seen.keys < 4000
    found = {names[h]: n for h, n in seen.frequent.items()}
    assert found["hot"] >= 2500 and found["warm"] >= 1500
    for key, n in counts.items():
        assert found.get(key, seen.rest) >= n
    # The bound of the rest rules out hot keys beside those found, or all keys are counted.
    right = frame(spark, "r", {k: 1 for k in counts})
    plain = left.join(right, "key").count()
    for cell in (40, 10):
        sizes = skew.KeySizes(seen, skew.unique(2002), skew.rows_of(left, ["key"]), skew.rows_of(right, ["key"]))
        suspects = sizes.suspects(skew.hot_from(cell, {"left_rows": 8000, "right_rows": 2002, "output_rows": 8000}))
        assert (suspects is None) == (cell == 10)
        assert skew.split_join(left, right, ["key"], ["l"], ["r"], sizes, cell=cell).count() == plain


def test_sketch_of_nothing_and_of_nulls(spark):
    none, both = skew.summarise(frame(spark, "l", {}), ["key"], ["key", "l"])
    assert (none.rows, none.frequent, none.rest) == (both.rows, both.frequent, both.rest) == (0, {}, 0)
    [seen] = skew.summarise(frame(spark, "l", {None: 40, "a": 2}), ["key"])
    assert (seen.rows, list(seen.frequent.values())) == (2, [2])


def test_one_artist_with_half_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(skew, "CELL", 4)
    pairs = [(f"t{i}", "various", 1) for i in range(200)] + [(f"t{i}", f"n{i}", 1) for i in range(200)]
    pairs = spark.createDataFrame(pairs, "song STRING, artist STRING, plays BIGINT")
    songs = song_rows(spark, [(f"s{i}", f"t{i}", "a", "0", "1") for i in range(200)])
    artists = spark.createDataFrame([("various",), ("various",), ("n3",)], "name STRING")
    got = {(r["song"], r["artist"], r["copies"]) for r in fact.match_pairs(pairs, songs, artists).collect()}
    assert got == {(f"t{i}", "various", 2) for i in range(200)} | {("t3", "n3", 1)}


def test_only_keys_beyond_a_cell_are_split(spark):
    left, right = frame(spark, "l", {"even": 20, "over": 21}), frame(spark, "r", {"even": 5, "over": 5})
    hot = skew._hot_keys(*insert(10, totals_of(left, right))).collect()
    names = hash_of(spark, "even", "over")
    assert [names[r["key_hash"]] for r in hot] == ["over"]


def song_rows(spark, rows):
    return spark.createDataFrame(
        rows, "song_id STRING, title STRING, artist_id STRING, year STRING, duration STRING"
    )


def test_many_copies_of_a_match(spark):
    """An artist with thousands of rows: every play comes out once per row."""
    plays = spark.createDataFrame(
        [(f"u{i}", "T", "N") for i in range(3)], "userId STRING, song STRING, artist STRING"
    ).selectExpr(
        "*", "current_timestamp() AS start_time", "'free' AS level", "1 AS sessionId", "'x' AS location",
        "'y' AS userAgent",
    )
    songs = song_rows(spark, [("S1", "T", "A1", "0", "1.5")])
    artists = spark.range(2500).select(F.lit("N").alias("name"))
    matches = fact.match_pairs(fact.count_pairs(plays), songs, artists)
    assert [r["copies"] for r in matches.collect()] == [2500]
    rows = fact.build_fact(plays, matches, ["userId"])
    assert {r["user_id"]: r["count"] for r in rows.groupBy("user_id").count().collect()} == {
        "u0": 2500, "u1": 2500, "u2": 2500,
    }


def test_hot_title_in_plays_and_songs(spark, monkeypatch):
    """Titles shared by many songs and played by many artists, with splitting forced on."""
    monkeypatch.setattr(skew, "CELL", 4)
    pairs = [("hot", f"n{i}", 7) for i in range(40)] + [("cold", "n1", 1)]
    pairs = spark.createDataFrame(pairs, "song STRING, artist STRING, plays BIGINT")
    songs = [(f"s{i // 3}", "hot", f"a{i % 2}", "0", f"{i}.5") for i in range(50)]
    songs = song_rows(spark, songs + [("s99", "cold", "a9", None, None)])
    artists = spark.createDataFrame([(f"n{i}",) for i in range(40) for _ in range(1 + i % 2)], "name STRING")
    matches = fact.match_pairs(pairs, songs, artists)
    expected = (
        pairs.join(songs, F.col("song") == F.col("title"))
        .join(artists, F.col("artist") == F.col("name"))
        .groupBy("song", "artist", "song_id", "artist_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    got = matches.groupBy("song", "artist", "song_id", "artist_id").agg(F.sum("copies").alias("copies"))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))
