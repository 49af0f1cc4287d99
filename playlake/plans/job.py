"""The whole job: JSON inputs to tables, counts and reports below one output folder.

Each raw input is scanned once. Everything after that reads staged or written Parquet.
"""

from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playlake import sinks
from playlake.functions.epoch import start_time
from playlake.operators import audit, dims, fact, reports
from playlake.parallel import in_order, widen
from playlake.scratch import discard, scratch_dir, stage
from playlake.session import utc_session
from playlake.sources.json_inputs import is_malformed, read_activity_log, read_song_metadata
from playlake.sources.schemas import PARTITION_COLUMNS, TABLE_SCHEMAS

# The log page that is a song play, and the folders of the count and ratio reports.
PLAY_PAGE = "NextSong"
COUNTS_FOLDER = "AllTblCnt"
RATIO_FOLDER = "paid_free_rt"

PLAY_COLUMNS = [
    "artist", "firstName", "gender", "lastName", "level", "location", "sessionId", "song", "ts",
    "userAgent", "userId",
]


# What the reconciliation compares.
SUMS_SCHEMA = "label STRING, n BIGINT, checksum DECIMAL(38,0)"

# A table that is built when it is asked for.
Built = Callable[[], DataFrame]


@dataclass
class Outcome:
    """What became of one output."""

    output: str
    path: str
    rows: int | None = None
    checksum: Decimal | None = None
    error: str | None = None


@dataclass
class RunResult:
    outcomes: dict[str, Outcome] = field(default_factory=dict)
    inputs: dict[str, int] = field(default_factory=dict)

    @property
    def failed(self) -> list[Outcome]:
        return [o for o in self.outcomes.values() if o.error is not None]


class JobFailed(RuntimeError):
    """Raised after all outputs were tried, if at least one could not be written."""

    def __init__(self, result: RunResult):
        self.result = result
        super().__init__("; ".join(f"{o.output}: {o.error}" for o in result.failed))


def run(
    spark: SparkSession, input_base: str, output_base: str, count_malformed_log: bool = False
) -> RunResult:
    """Run the job, in a session of its own. One failed output does not stop the others; unreadable input does.

    `count_malformed_log` counts unreadable log lines, which the page filter drops. It makes the
    largest scan about a third slower, as every field of every line has to be converted.
    """
    spark = utc_session(spark)
    work = scratch_dir(spark)
    try:
        result = _Run(spark, input_base, output_base, work).run(count_malformed_log)
    finally:
        discard(spark, work)
    if result.failed:
        raise JobFailed(result)
    return result


def stage_songs(spark: SparkSession, input_base: str, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Song metadata as a table. The rebalance merges the many one-object files into few."""
    # Counted after the shuffle: a map task that runs again would be counted again.
    raw = read_song_metadata(spark, input_base).hint("rebalance")
    seen = Observation()
    raw = raw.observe(
        seen,
        F.count(F.lit(1)).alias("song_rows"),
        F.count_if(is_malformed(raw)).alias("malformed_song_rows"),
    )
    return stage(raw.drop("num_songs"), path), seen.get


def stage_plays(
    spark: SparkSession, input_base: str, path: str, count_malformed: bool
) -> tuple[DataFrame, dict[str, int]]:
    """Song plays of the log as a table, with `start_time` and a number per row."""
    log = read_activity_log(spark, input_base)
    seen_log, seen_plays = Observation(), Observation()
    if count_malformed:
        log = log.observe(
            seen_log,
            F.count(F.lit(1)).alias("log_rows"),
            F.count_if(is_malformed(log)).alias("malformed_log_rows"),
        )
    plays = (
        dims.filter_page(log, PLAY_PAGE)
        .select(*PLAY_COLUMNS, start_time("ts").alias("start_time"))
        .withColumn("play_no", F.monotonically_increasing_id())
    )
    plays = plays.observe(
        seen_plays,
        F.count(F.lit(1)).alias("plays"),
        F.count_if(F.col("start_time").isNull()).alias("plays_without_time"),
    )
    staged = stage(plays, path)
    return staged, {**(seen_log.get if count_malformed else {}), **seen_plays.get}


class _Run:
    def __init__(self, spark: SparkSession, input_base: str, output_base: str, work: str):
        self.spark = spark
        self.input_base = input_base
        self.output_base = output_base.rstrip("/")
        self.work = work
        self.result = RunResult()
        self.noting = Lock()
        self.rows = 0
        # Tables for the steps that follow: as written, or as planned if the write failed.
        self.tables: dict[str, Built] = {}

    def run(self, count_malformed_log: bool) -> RunResult:
        in_order(self.spark, self.steps(count_malformed_log))
        return self.result

    def steps(self, count_malformed_log: bool) -> dict[str, tuple[list[str], Callable[[], object]]]:
        """Every step with those it needs. Steps keep their errors to themselves, but for the two inputs.

        Tables are written as built, and not as re-read: re-read partition columns have '' turned into NULL.
        """
        built: dict[str, Built] = {}
        table = self.tables

        def prepare(name: str, build: Built) -> Callable[[], None]:
            return lambda: built.update({name: self.prepare(name, build)})

        def report(name: str, build: Built, header: bool = True) -> Callable[[], None]:
            return lambda: self.write_csv(name, build, header)

        def read_songs() -> None:
            staged, seen = stage_songs(self.spark, self.input_base, f"{self.work}/metadata")
            self.took(seen, "song_rows")
            built["metadata"] = lambda: staged

        def read_plays() -> None:
            staged, seen = stage_plays(self.spark, self.input_base, f"{self.work}/plays", count_malformed_log)
            self.took(seen, "plays")
            built["plays"] = lambda: staged

        def song_plays() -> DataFrame:
            plays = fact.dense_numbers(built["plays"](), "play_no")
            return fact.build_fact(plays, built["matches"](), ["play_no"], built["pairs"](), "play_no")

        counted, songs = lambda: built["report_counts"](), lambda: built["songs_built"]()
        tables = ["artists", "users", "song_plays", "songs", "time"]
        return {
            "metadata": ([], read_songs),
            "plays": ([], read_plays),
            "songs_built": (["metadata"], prepare("songs_built", lambda: dims.songs_dim(built["metadata"]()))),
            "pairs": (["plays"], prepare("pairs", lambda: fact.count_pairs(fact.valid_plays(built["plays"]())))),
            "time_built": (["plays"], prepare("time_built", lambda: dims.time_dim(built["plays"]()))),
            "artists": (["metadata"], lambda: self.write_table("artists", lambda: dims.artists_dim(built["metadata"]()))),
            "users": (["plays"], lambda: self.write_table("users", lambda: dims.users_dim(built["plays"]()))),
            "matches": (["songs_built", "pairs", "artists"], prepare(
                "matches", lambda: fact.match_pairs(built["pairs"](), songs(), table["artists"]()))),
            "song_plays": (["matches", "pairs"], lambda: self.write_table("song_plays", song_plays)),
            "songs": (["songs_built"], lambda: self.write_table("songs", songs)),
            "time": (["time_built"], lambda: self.write_table("time", built["time_built"])),
            # From plays per (artist, song), which follow from the matches without the fact.
            "report_counts": (["matches"], prepare("report_counts", lambda: reports.song_plays_of_matches(built["matches"]()))),
            "top_songs": (["report_counts"], report(
                "top_songs", lambda: reports.top_songs(counted(), songs(), table["artists"]()))),
            "top_artists": (["report_counts"], report(
                "top_artists", lambda: reports.top_artists(counted(), songs(), table["artists"]()))),
            "top_artists_by_plays": (["report_counts"], report(
                "top_artists_by_plays", lambda: reports.top_artists_by_plays(counted(), table["artists"]()))),
            RATIO_FOLDER: (["users"], report(RATIO_FOLDER, lambda: reports.free_paid_ratio(table["users"]()))),
            COUNTS_FOLDER: (tables, report(COUNTS_FOLDER, self.recorded_counts, header=False)),
            "reconciliation": (tables, report("reconciliation", self.reconciliation)),
            "input_audit": (["metadata", "plays"], report("input_audit", self.input_audit)),
        }

    def took(self, seen: dict[str, int], rows: str) -> None:
        """Note what an input holds, and make shuffles wide enough for the rows of both."""
        with self.noting:
            self.result.inputs.update(seen)
            self.rows += seen[rows]
            widen(self.spark, self.rows)

    def recorded(self) -> DataFrame:
        """Counts and checksums taken while the tables were written; a table that failed is counted as planned, if it can be."""
        rows = []
        for table, label in audit.LABELS.items():
            outcome = self.result.outcomes[table]
            written = outcome.rows
            if written is None:
                try:
                    written = self.tables[table]().count()
                except Exception:  # its own outcome says why
                    continue
            rows.append((label, written, outcome.checksum))
        return self.spark.createDataFrame(rows, SUMS_SCHEMA).coalesce(1)

    def recorded_counts(self) -> DataFrame:
        return self.recorded().select("label", "n")

    def reconciliation(self) -> DataFrame:
        written = {
            table: self.spark.read.schema(schema).parquet(f"{self.output_base}/{table}")
            for table, schema in TABLE_SCHEMAS.items()
            if self.result.outcomes[table].error is None
        }
        sums = audit.table_sums(written, PARTITION_COLUMNS) if written else self.spark.createDataFrame([], SUMS_SCHEMA)
        return audit.reconcile_counts(self.recorded(), sums).orderBy("label")

    def input_audit(self) -> DataFrame:
        rows = list(self.result.inputs.items())
        return self.spark.createDataFrame(rows, "check STRING, n BIGINT").coalesce(1)

    def prepare(self, name: str, build: Built) -> Built:
        """Stage an intermediate table. If that fails, every step that asks for it fails with the reason."""
        path = f"{self.work}/{name}"
        try:
            staged = stage(build(), path)
        except Exception as error:
            reason = f"{name}: {_first_line(error)}"

            def unavailable() -> DataFrame:
                raise RuntimeError(reason)

            return unavailable
        return lambda: staged

    def write_table(self, table: str, build: Built) -> None:
        path = f"{self.output_base}/{table}"
        columns = PARTITION_COLUMNS.get(table)

        def write() -> sinks.Written:
            if columns:
                return sinks.write_partitioned(build(), path, columns)
            return sinks.write_table(build(), path)

        done = self.attempt(table, path, write)
        written = lambda: self.spark.read.schema(TABLE_SCHEMAS[table]).parquet(path)
        self.tables[table] = written if done else build

    def write_csv(self, output: str, build: Built, header: bool = True) -> None:
        path = f"{self.output_base}/{output}"
        self.attempt(output, path, lambda: sinks.write_csv(build(), path, header))

    def attempt(self, output: str, path: str, write: Callable[[], sinks.Written]) -> bool:
        outcome = self.result.outcomes[output] = Outcome(output, path)
        try:
            written = write()
            outcome.rows, outcome.checksum = written.rows, written.checksum
        except Exception as error:  # reported at the end of the run
            outcome.error = _first_line(error)
        return outcome.error is None


def _first_line(error: Exception) -> str:
    return str(error).strip().splitlines()[0] if str(error).strip() else repr(error)
