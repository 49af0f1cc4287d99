"""The song-play fact: plays joined to songs by title and to artists by name.

One play gives one row for every song row of its title and every artist row of its name. Plays
repeat few (song, artist) pairs many times, so the dimensions are matched to the counted pairs
first. Full play rows are then shuffled once, and counts need no play rows at all.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlake.operators.skew import CELL, KeySizes, rows_of, split_join, summarise, summarise_counts, unique
from playlake.parallel import together

PAIR = ["song", "artist"]
# The matches of one pair are numbered in so many slots side by side.
SLOTS = 4096
# Bits of the row's place in its task, in the numbers that `monotonically_increasing_id` gives.
PLACE_BITS = 33


def valid_plays(plays: DataFrame) -> DataFrame:
    """Plays that can reach the fact: with a valid time and both join keys."""
    return plays.dropna(subset=["start_time", *PAIR])


def count_pairs(plays: DataFrame) -> DataFrame:
    """Plays per (song title, artist name)."""
    return plays.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("plays"))


def match_pairs(pairs: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Song rows matched by each pair, with the number of fact rows (`copies`) one play gives of each.

    `pairs` and `songs` are read twice, so they should be stored tables. Song rows that differ only
    in year or duration are told apart by `variant`.
    """
    titles = songs.where(F.col("title").isNotNull()).select(
        F.col("title").alias("song"),
        "song_id",
        "artist_id",
        F.xxhash64("year", "duration").alias("variant"),
    )
    names = (
        artists.where(F.col("name").isNotNull())
        .groupBy(F.col("name").alias("artist"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    (of_artist, of_song), [of_title] = together(
        pairs.sparkSession, lambda: summarise(pairs, ["artist"], ["song"]), lambda: summarise(titles, ["song"])
    )
    # A name meets at most each pair of its artist, so no more names than artists of pairs matter.
    sizes = KeySizes(
        of_artist, unique(int(of_artist.keys)), rows_of(pairs, ["artist"]), rows_of(names, ["artist"]), of_artist.rows
    )
    named = split_join(pairs, names, ["artist"], ["song"], ["copies"], sizes)
    sizes = KeySizes(of_song, of_title, rows_of(pairs, ["song"]), rows_of(titles, ["song"]))
    matches = split_join(named, titles, ["song"], ["artist"], ["song_id", "artist_id", "variant"], sizes)
    return matches.select(*PAIR, "plays", "song_id", "artist_id", "variant", "copies")


def dense_numbers(plays: DataFrame, number: str) -> DataFrame:
    """Replace ids of `monotonically_increasing_id`, which leave most of 64 bits unused, by numbers without such gaps.

    What is broadcast has one row per task that gave the ids. `plays` is read twice, so it should be a stored table.
    """
    task = F.shiftright(number, PLACE_BITS)
    used = F.max(F.col(number) - F.shiftleft(task, PLACE_BITS)) + 1
    tasks = plays.groupBy(task.alias("task")).agg(used.alias("used"))
    before = F.sum("used").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    moved = tasks.select(
        "task", (F.coalesce(before, F.lit(0)) - F.shiftleft("task", PLACE_BITS)).alias("moved")
    )
    joined = plays.join(F.broadcast(moved), F.shiftright(plays[number], PLACE_BITS) == moved["task"])
    return joined.select(
        *[(plays[c] + moved["moved"]).alias(c) if c == number else plays[c] for c in plays.columns]
    )


def with_positions(matches: DataFrame) -> DataFrame:
    """Add `position`: how many fact rows of a play come before those of this match, by song, artist and variant.

    A pair with many matches is numbered slot by slot, so no task gets all of them.
    """
    order = ["song_id", "artist_id", "variant"]
    slotted = matches.withColumn("slot", F.pmod(F.xxhash64(*order), F.lit(SLOTS)))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*PAIR, "slot").orderBy(*order).rowsBetween(*earlier)
    across = Window.partitionBy(*PAIR).orderBy("slot").rowsBetween(*earlier)
    slots = slotted.groupBy(*PAIR, "slot").agg(F.sum("copies").alias("in_slot"))
    slots = slots.select(*PAIR, "slot", F.coalesce(F.sum("in_slot").over(across), F.lit(0)).alias("before"))
    placed = slotted.withColumn("position", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return placed.join(slots, [*PAIR, "slot"]).select(*matches.columns, (F.col("before") + F.col("position")).alias("position"))


def build_fact(
    plays: DataFrame,
    matches: DataFrame,
    spread: list[str],
    pairs: DataFrame | None = None,
    number: str | None = None,
) -> DataFrame:
    """Fact rows. `spread` are columns of `plays` that tell its rows apart.

    `matches` is read twice, so it should be a stored table. With `pairs`, the counted pairs, plays of
    frequent pairs without a match are dropped before the shuffle.

    With `number`, a column of unique, non-negative numbers of the plays, rows have a `songplay_id`: the number of the play
    times the most rows that a play gives, plus the row's place among those of its play. So it is unique, and follows from
    the rows and not from the tasks that make them. Ids that do not fit 64 bits raise an overflow.
    """
    # Many copies of a match become several rows here, so that no play row expands without bound.
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {CELL}")))
    numbered = with_positions(matches) if number else matches.withColumn("position", F.lit(0).cast("bigint"))
    lookup = (
        numbered.drop("plays")
        .select("*", chunks.alias("chunk"))
        .withColumn("copies", F.least(F.lit(CELL).cast("bigint"), F.col("copies") - F.col("chunk") * CELL))
        .withColumn("position", F.col("position") + F.col("chunk") * CELL)
    )
    if pairs is None:
        pairs = matches.groupBy(*PAIR).agg(F.max("plays").alias("plays"))
    of_play = matches.groupBy(*PAIR).agg(F.sum("copies").alias("rows"))
    of_pair, [of_match], [most_copies, rows], [most_rows] = together(
        matches.sparkSession,
        lambda: summarise_counts(pairs, PAIR, "plays"),
        lambda: summarise(matches, PAIR),
        lambda: matches.agg(F.max("copies"), F.sum(F.col("plays") * F.col("copies"))).first(),
        lambda: of_play.agg(F.max("rows")).first() if number else [None],
    )
    sizes = KeySizes(
        of_pair,
        of_match.times(most_copies or 0),
        rows_of(pairs, PAIR, F.col("plays")),
        rows_of(matches, PAIR, F.col("copies")),
        rows or 0,
    )
    lookup_spread = ["song_id", "artist_id", "variant", "chunk"]
    # By pair, as plays of a pair repeat its matches: side by side they take a small part of the space when stored.
    joined = split_join(valid_plays(plays), lookup, PAIR, spread, lookup_spread, sizes, by_key=True)
    row_id = []
    if number:
        place = F.col("position") + F.col("copy") - 1
        row_id = [(F.col(number).cast("bigint") * F.lit(most_rows or 1) + place).alias("songplay_id")]
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(
        "start_time",
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *row_id,
    )
