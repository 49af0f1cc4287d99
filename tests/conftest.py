import json
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("playlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def write_lines(path: Path, lines: list) -> None:
    """Write dicts as JSON lines; text goes in as it is."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def song(song_id="S1", title="T", artist_id="A1", artist_name="N", **more) -> dict:
    row = dict(
        num_songs=1, artist_id=artist_id, artist_latitude=None, artist_longitude=None,
        artist_location="", artist_name=artist_name, song_id=song_id, title=title,
        duration=200.12345, year=0,
    )
    return row | more


def play(song="T", artist="N", ts=1600000000123, user="1", level="free", **more) -> dict:
    row = dict(
        artist=artist, auth="Logged In", firstName="Ada", gender="X", itemInSession=1, lastName="Byte",
        length=200.5, level=level, location="Somewhere", method="PUT", page="NextSong",
        registration=1500000000123.0, sessionId=77, song=song, status=200, ts=ts,
        userAgent="Browser", userId=user,
    )
    return row | more


class Inputs:
    """Input folder tree of one test."""

    def __init__(self, base: Path):
        self.base = base

    def songs(self, *rows, name="a.json"):
        # One object per file, as in the real input.
        for i, row in enumerate(rows):
            write_lines(self.base / "song_data/A/B/C" / f"{i}{name}", [row])
        return self

    def log(self, *rows, name="2018-11-01-events.json"):
        write_lines(self.base / "log_data/2018/11" / name, list(rows))
        return self

    def __str__(self):
        return str(self.base)


@pytest.fixture
def inputs(tmp_path):
    return Inputs(tmp_path / "in")
