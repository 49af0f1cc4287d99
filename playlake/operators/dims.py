"""The four dimensions. Rows are distinct as a whole, not by key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.functions.epoch import calendar_parts, start_time


def filter_page(log: DataFrame, page: str, column: str = "page") -> DataFrame:
    """Rows of one page; case-sensitive, a NULL page is dropped."""
    return log.where(F.col(column) == page)


def songs_dim(metadata: DataFrame) -> DataFrame:
    return metadata.select("song_id", "title", "artist_id", "year", "duration").distinct()


def artists_dim(metadata: DataFrame) -> DataFrame:
    return metadata.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    ).distinct()


def users_dim(plays: DataFrame) -> DataFrame:
    return plays.select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
    ).distinct()


def time_dim(plays: DataFrame) -> DataFrame:
    """One row per distinct `ts` that is a valid time.

    `start_time` depends on `ts` alone, so only `ts` is shuffled and the rest is derived after.
    """
    return (
        plays.select("ts")
        .distinct()
        .withColumn("start_time", start_time("ts"))
        .where(F.col("start_time").isNotNull())
        .withColumns(calendar_parts("start_time"))
    )
