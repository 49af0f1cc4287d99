"""The star of one small input, built by the operators without the job around them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from playlake.functions.epoch import start_time
from playlake.operators import dims, fact, reports
from playlake.sources.json_inputs import read_activity_log, read_song_metadata


@dataclass
class Star:
    songs: DataFrame
    artists: DataFrame
    users: DataFrame
    time: DataFrame
    fact: DataFrame

    @property
    def song_plays(self) -> DataFrame:
        return reports.song_plays(self.fact)


def build(spark, inputs) -> Star:
    metadata = read_song_metadata(spark, str(inputs))
    log = dims.filter_page(read_activity_log(spark, str(inputs)), "NextSong")
    plays = log.withColumn("start_time", start_time("ts"))
    songs, artists = dims.songs_dim(metadata), dims.artists_dim(metadata)
    matches = fact.match_pairs(fact.count_pairs(fact.valid_plays(plays)), songs, artists)
    rows = fact.build_fact(plays, matches, ["ts", "userId", "sessionId", "itemInSession"])
    return Star(songs, artists, dims.users_dim(plays), dims.time_dim(plays), rows)


def lines(df) -> list:
    return [row[0] for row in df.collect()]
