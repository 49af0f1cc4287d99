"""One test per awkward behaviour; F numbers refer to FIXTURES.md."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import star
from conftest import play, song, write_lines
from playlake.functions.epoch import calendar_parts, start_time
from playlake.operators import dims, fact, reports
from playlake.session import child_session
from playlake.sources.json_inputs import is_malformed, read_activity_log, read_song_metadata


def times(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ts STRING")
    return df.withColumn("start_time", start_time("ts"))


def test_f1_user_seen_on_two_levels_gives_two_rows(spark, inputs):
    inputs.songs(song()).log(play(level="free"), play(level="paid"), play(level="paid"))
    users = star.build(spark, inputs).users
    assert sorted(r["level"] for r in users.collect()) == ["free", "paid"]
    row = reports.free_paid_ratio(users).first()
    assert tuple(row) == ("Ratio: ", "Free users: 1", "Paid users: 1", "1.0:1.0")


def test_f2_page_filter_is_case_sensitive_and_drops_null(spark, inputs):
    inputs.log(*[play(page=p) for p in ("NextSong", "nextsong", "Home", None)])
    log = read_activity_log(spark, str(inputs))
    assert log.count() == 4
    assert dims.filter_page(log, "NextSong").count() == 1


def test_f3_f4_title_and_name_matches_multiply(spark, inputs):
    inputs.songs(
        song("S1", "T", "A1", "N", artist_location="x"),
        song("S2", "T", "A2", "M"),
        song("S3", "U", "A1", "N", artist_location="y"),
    ).log(play("T", "N"))
    rows = star.build(spark, inputs).fact.collect()
    assert len(rows) == 4
    assert sorted((r["song_id"], r["artist_id"]) for r in rows) == [("S1", "A1")] * 2 + [("S2", "A2")] * 2


def test_f5_unmatched_and_null_names_disappear(spark, inputs):
    inputs.songs(song(), song("S2", None, "A2", None)).log(
        play("unknown", "N"), play("T", "unknown"), play("T", None), play(None, "N"), play(None, None)
    )
    assert star.build(spark, inputs).fact.count() == 0


def test_f6_plays_of_one_time_share_a_time_row(spark, inputs):
    inputs.songs(song()).log(play(user="1"), play(user="2"), play(user="3"))
    built = star.build(spark, inputs)
    assert built.time.count() == 1
    rows = built.fact.collect()
    assert len(rows) == 3 and len({r["start_time"] for r in rows}) == 1


def test_f7_start_time_and_calendar_parts(spark):
    row = times(spark, ["1600000000123"]).withColumns(calendar_parts("start_time")).first()
    assert row["start_time"] == dt.datetime(2020, 9, 13, 12, 26, 40, 123000)
    assert [row[c] for c in ("hour", "day", "week", "month", "year", "weekday")] == [12, 13, 37, 9, 2020, 1]


def test_f7_iso_week_belongs_to_next_year_but_year_does_not(spark):
    row = times(spark, ["1546214400000"]).withColumns(calendar_parts("start_time")).first()
    assert (row["week"], row["year"], row["weekday"]) == (1, 2018, 2)


def test_f7_fractions_and_negative_times(spark):
    got = {r["ts"]: r["start_time"] for r in times(spark, ["1600000000123.5", "-1.5", "0", "1.0E12"]).collect()}
    assert got["1600000000123.5"] == dt.datetime(2020, 9, 13, 12, 26, 40, 123500)
    assert got["-1.5"] == dt.datetime(1969, 12, 31, 23, 59, 59, 998500)
    assert got["0"] == dt.datetime(1970, 1, 1)
    assert got["1.0E12"] == dt.datetime(2001, 9, 9, 1, 46, 40)


def test_f8_bad_times_are_left_out(spark, inputs):
    inputs.songs(song()).log(play(ts=None), play(ts="abc"), play(ts=""), play(ts="NaN"), play(ts=9e300), play())
    built = star.build(spark, inputs)
    assert built.time.count() == 1
    assert built.fact.count() == 1
    assert built.users.count() == 1


def test_f8_only_decimal_numbers_are_times(spark):
    bad = ["1600000000123d", "1600000000123f", "1600000000123D", "0x1p40", "0x10", "1_000", "1e", ".", "+", "--1", "1 2"]
    assert times(spark, bad).where(F.col("start_time").isNotNull()).count() == 0
    good = [" 1600000000123 ", "+1", "1.", ".5", "1E3", "1e+3"]
    assert times(spark, good).where(F.col("start_time").isNull()).count() == 0


def test_f8_out_of_range_times_are_null(spark):
    bad = [None, "", "abc", "NaN", "Infinity", "-Infinity", "9e300", "253402300800000", "-62135596800001"]
    assert times(spark, bad).where(F.col("start_time").isNotNull()).count() == 0
    edge = ["253402300799999", "-62135596800000"]
    assert times(spark, edge).where(F.col("start_time").isNull()).count() == 0


def test_f9_repeated_hour_is_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = times(spark, ["1541323800000"]).select(F.unix_millis("start_time")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row[0] == 1541323800000


def test_f10_ties_and_equal_messages(spark, inputs):
    # Twelve songs: two clear winners and ten ties for the last eight places.
    inputs.songs(*[song(f"S{i:02}", f"T{i:02}", f"A{i:02}", f"N{i:02}") for i in range(12)]).log(
        *[play(f"T{i:02}", f"N{i:02}", ts=1600000000123 + k) for i in range(12) for k in range(2 if i > 9 else 1)]
    )
    built = star.build(spark, inputs)
    got = star.lines(reports.top_songs(built.song_plays, built.songs, built.artists))
    expected = [f'"T{i}" by N{i} played 2 times.' for i in (10, 11)]
    expected += [f'"T{i:02}" by N{i:02} played 1 times.' for i in range(8)]
    assert got == expected


def test_f10_songs_with_equal_title_artist_and_count_share_a_line(spark, inputs):
    inputs.songs(song("S1", "T"), song("S2", "T"), song("S3", "U")).log(play("T"), play("U"))
    built = star.build(spark, inputs)
    got = star.lines(reports.top_songs(built.song_plays, built.songs, built.artists))
    assert got == ['"T" by N played 1 times.', '"U" by N played 1 times.']


def test_f11_top_artists_is_by_song_id(spark, inputs):
    # Ids sort as text: s1 comes last, so A's only song is the eleventh.
    names = [f"s{i}" for i in range(2, 12)]
    inputs.songs(song("s1", "hit", "A", "Ann"), *[song(s, s, "B", "Bob") for s in names]).log(
        *[play("hit", "Ann", ts=1600000000123 + k) for k in range(100)], *[play(s, "Bob") for s in names]
    )
    built = star.build(spark, inputs)
    by_id = star.lines(reports.top_artists(built.song_plays, built.songs, built.artists))
    assert by_id == ['"Bob" was played 1 times.']
    by_plays = star.lines(reports.top_artists_by_plays(built.song_plays, built.artists))
    assert by_plays == ['"Ann" was played 100 times.', '"Bob" was played 10 times.']


@pytest.mark.parametrize(
    "levels, ratio",
    [
        (["free", "free"], None),
        (["paid"], "0.0:1.0"),
        (["free"] * 82 + ["paid"] * 22, "3.727272727272727:1.0"),
    ],
)
def test_f12_ratio(spark, levels, ratio):
    users = spark.createDataFrame([(str(i), v) for i, v in enumerate(levels)], "user_id STRING, level STRING")
    row = reports.free_paid_ratio(users).first()
    assert row["ratio"] == ratio
    assert row["free_users"] == f"Free users: {levels.count('free')}"


def test_ratio_counts_only_rows_with_an_id(spark):
    users = spark.createDataFrame(
        [(None, "free"), ("", "free"), ("1", "paid"), ("2", "Free")], "user_id STRING, level STRING"
    )
    assert reports.free_paid_ratio(users).first()["ratio"] == "1.0:1.0"


def test_f13_malformed_line_and_mistyped_field(spark, inputs):
    inputs.songs(song(), "{not json", song("S2", num_songs="many"))
    metadata = read_song_metadata(spark, str(inputs))
    assert metadata.where(is_malformed(metadata)).count() == 1
    assert [r["song_id"] for r in metadata.where("num_songs IS NULL AND song_id IS NOT NULL").collect()] == ["S2"]
    assert dims.songs_dim(metadata).count() == 3


def test_numbers_read_as_text_keep_their_digits(spark, inputs):
    inputs.songs(song(duration=200.12345, year=0)).log(play())
    row = read_song_metadata(spark, str(inputs)).first()
    assert (row["duration"], row["year"]) == ("200.12345", "0")
    log = read_activity_log(spark, str(inputs)).first()
    assert (log["ts"], log["registration"]) == ("1600000000123", 1500000000123.0)


def test_only_files_at_the_exact_depth_are_read(spark, inputs):
    base = inputs.base / "song_data"
    write_lines(base / "A/B/C/ok.json", [song("ok")])
    write_lines(base / "A/B/shallow.json", [song("shallow")])
    write_lines(base / "A/B/C/D/deep.json", [song("deep")])
    write_lines(base / "A/B/C/other.txt", [song("other")])
    write_lines(base / "year=1/k=2/C/named.json", [song("named")])
    metadata = read_song_metadata(spark, str(inputs))
    assert sorted(r["song_id"] for r in metadata.collect()) == ["named", "ok"]
    assert len(metadata.columns) == 10

    base = inputs.base / "log_data"
    write_lines(base / "year=2018/11/ok.json", [play(user="ok")])
    write_lines(base / "2018/shallow.json", [play(user="shallow")])
    write_lines(base / "2018/11/12/deep.json", [play(user="deep")])
    log = read_activity_log(spark, str(inputs))
    assert [r["userId"] for r in log.collect()] == ["ok"]
    assert len(log.columns) == 18

    write_lines(inputs.base / "song_data/song_data/A/B/C/nested.json", [song("nested")])
    assert sorted(r["song_id"] for r in read_song_metadata(spark, str(inputs)).collect()) == ["named", "ok"]


def test_base_may_end_in_a_slash_and_hold_a_blank(spark, inputs):
    base = inputs.base / "in put"
    write_lines(base / "log_data/2018/11/2018-11-01-events.json", [play(), play()])
    assert read_activity_log(spark, f"{base}/").count() == 2


def test_whole_row_distinct_treats_nulls_as_equal_and_empty_text_as_different(spark, inputs):
    inputs.songs(song("S1", artist_location=None), song("S2", artist_location=None), song("S3"))
    artists = star.build(spark, inputs.log(play())).artists
    assert sorted(str(r["location"]) for r in artists.collect()) == ["", "None"]


# Row ids


def test_row_ids_follow_from_the_rows(spark, inputs):
    """The same whatever the shuffle width, unique also for copies, repeated songs and repeated plays."""
    inputs.songs(
        *[song(f"S{i % 5}", "T", "A1", "N", year=i) for i in range(9)],
        *[song(f"S{i}", "U", f"A{i}", "N", artist_location=f"L{i % 2}") for i in range(6)],
    ).log(*[play("TU"[i % 2], "N", ts=1600000000123 + i // 4) for i in range(40)])
    metadata = read_song_metadata(spark, str(inputs))
    songs, artists = dims.songs_dim(metadata), dims.artists_dim(metadata)
    log = dims.filter_page(read_activity_log(spark, str(inputs)), "NextSong")
    plays = log.withColumn("start_time", start_time("ts")).withColumn("play_no", F.monotonically_increasing_id())
    runs = []
    for width in ("4", "16"):
        child = child_session(spark, **{"spark.sql.shuffle.partitions": width})
        on_child = [child.createDataFrame(df.collect(), df.schema) for df in (plays, songs, artists)]
        pairs = fact.count_pairs(on_child[0])
        matches = fact.match_pairs(pairs, *on_child[1:])
        rows = fact.build_fact(fact.dense_numbers(on_child[0], "play_no"), matches, ["play_no"], pairs, "play_no")
        runs.append(sorted(rows.collect(), key=lambda r: r.songplay_id))
    ids = [r.songplay_id for r in runs[0]]
    assert runs[0] == runs[1] and len(set(ids)) == len(ids) == 20 * (9 + 6) * artists.where("name = 'N'").count()
    assert 0 <= min(ids) and max(ids) < 40 * (len(ids) // 20)


def test_positions_of_many_matches_are_gapless(spark, monkeypatch):
    monkeypatch.setattr(fact, "SLOTS", 3)
    rows = [("s", "a", 1, f"S{i % 7}", "A", i // 7 % 4, 1 + i % 5) for i in range(200)] + [("s", "b", 1, "S", "A", 0, 2)]
    schema = "song STRING, artist STRING, plays BIGINT, song_id STRING, artist_id STRING, variant BIGINT, copies BIGINT"
    got = fact.with_positions(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r[:-1] for r in got) == sorted(rows)
    spans = sorted((r.position, r.position + r.copies) for r in got if r.artist == "a")
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [r.position for r in got if r.artist == "b"] == [0]


def test_dense_numbers_keep_order_and_are_below_the_rows(spark):
    ids = [(t << 33) + i for t, n in ((0, 3), (2, 1), (7, 5)) for i in range(n)]
    got = fact.dense_numbers(spark.createDataFrame([(i, "x") for i in ids], "play_no BIGINT, moved STRING"), "play_no")
    assert sorted(r.play_no for r in got.collect()) == list(range(9)) and got.columns == ["play_no", "moved"]


def test_ids_beyond_64_bits_raise(spark):
    plays = spark.createDataFrame([(1 << 62, "s", "a", "2020")], "play_no BIGINT, song STRING, artist STRING, start_time STRING")
    plays = plays.select("*", *[F.lit("x").alias(c) for c in ("userId", "level", "sessionId", "location", "userAgent")])
    schema = "song STRING, artist STRING, plays BIGINT, song_id STRING, artist_id STRING, variant BIGINT, copies BIGINT"
    matches = spark.createDataFrame([("s", "a", 1, "S", "A", 0, 4)], schema)
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        fact.build_fact(plays, matches, ["play_no"], number="play_no").collect()
