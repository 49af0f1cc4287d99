"""The reports. Ties are broken by id, so that they come out the same every time.

The song and artist reports start from rows of (artist_id, song_id, plays) and sum up the plays.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.functions import messages as text

TOP = 10


def song_plays(fact: DataFrame) -> DataFrame:
    """Plays per (artist, song) of the fact."""
    return fact.groupBy("artist_id", "song_id").agg(F.count(F.lit(1)).alias("plays"))


def song_plays_of_matches(matches: DataFrame) -> DataFrame:
    """The same from `match_pairs`, without building the fact; a song may have several rows."""
    return matches.select(
        "artist_id", "song_id", (F.col("plays") * F.col("copies")).alias("plays")
    )


def top_songs(plays: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Lines for the ten most played songs: one per title, artist name and count."""
    top = (
        plays.groupBy("song_id")
        .agg(F.sum("plays").alias("plays"))
        .orderBy(F.desc("plays"), "song_id")
        .limit(TOP)
    )
    titles = (
        songs.select("song_id", "title", "artist_id")
        .join(F.broadcast(top), "song_id")
        .select("title", "artist_id", "plays")
        .distinct()
    )
    lines = titles.join(artists.select("artist_id", "name"), "artist_id")
    return _sorted_lines(
        lines.select("title", "name", "plays").distinct(), text.song_line("title", "name", "plays")
    )


def top_artists(plays: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Lines for the ten (artist, song) groups with the highest song id, one per name and count.

    The order is by song id, as in the job this one replaces, not by plays; see
    `top_artists_by_plays` for that. The song lookup only checks that the song exists.
    """
    top = (
        plays.groupBy("artist_id", "song_id")
        .agg(F.sum("plays").alias("plays"))
        .orderBy(F.desc("song_id"), "artist_id")
        .limit(TOP)
    )
    known = songs.select("song_id").join(F.broadcast(top), "song_id").distinct()
    lines = artists.select("artist_id", "name").join(F.broadcast(known), "artist_id")
    return _sorted_lines(lines.select("name", "plays").distinct(), text.artist_line("name", "plays"))


def top_artists_by_plays(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """Lines for the ten most played artists, one per artist and name."""
    top = (
        plays.groupBy("artist_id")
        .agg(F.sum("plays").alias("plays"))
        .orderBy(F.desc("plays"), "artist_id")
        .limit(TOP)
    )
    lines = artists.select("artist_id", "name").join(F.broadcast(top), "artist_id").distinct()
    return _sorted_lines(lines, text.artist_line("name", "plays"))


def free_paid_ratio(users: DataFrame) -> DataFrame:
    """Rows of `users` on the free and on the paid level, and their ratio, in one pass."""
    counts = users.agg(
        F.count(F.when(F.col("level") == "free", F.col("user_id"))).alias("free"),
        F.count(F.when(F.col("level") == "paid", F.col("user_id"))).alias("paid"),
    )
    return counts.select(
        F.lit(text.RATIO_LABEL).alias("label"),
        text.labelled(text.FREE_LABEL, "free").alias("free_users"),
        text.labelled(text.PAID_LABEL, "paid").alias("paid_users"),
        text.ratio("free", "paid").alias("ratio"),
    )


def _sorted_lines(rows: DataFrame, message: Column) -> DataFrame:
    lines = rows.select("plays", message.alias("message"))
    return lines.orderBy(F.desc("plays"), "message").select("message")
