"""Registered queries: each operator of the job on the given tables."""

from collections.abc import Callable
from functools import wraps
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake import sinks
from playlake.catalog import drop_tables, register_tables, register_views
from playlake.functions.epoch import epoch_ms_text
from playlake.operators import audit, dims, fact, reports
from playlake.parallel import together
from playlake.plans import job
from playlake.plans import standins as s
from playlake.scratch import exists, file_states, scratch_dir, stage
from playlake.session import utc_session
from playlake.sources.json_inputs import read_activity_log, read_song_metadata
from playlake.sources.schemas import PARTITION_COLUMNS, TABLE_SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]


def without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


# Sources


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark)
    events = s.table(spark, sf_dir, "events")
    events.select(
        epoch_ms_text("ts").cast("bigint").alias("ts"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("page"),
        F.col("value").alias("length"),
        F.col("props").alias("song"),
        F.concat(F.lit("n"), "user_id").alias("firstName"),
        (F.col("event_id") % 7).alias("itemInSession"),
        F.col("event_id").alias("registration"),
        F.when(F.col("event_id") % 2 == 0, 200).alias("status"),
        F.lit("PUT").alias("method"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
    ).write.partitionBy("y", "m").json(f"{base}/log_data")
    return read_activity_log(spark, base)


def json_scan_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark)
    part = s.table(spark, sf_dir, "part")
    part.select(
        F.lit(1).alias("num_songs"),
        s.text("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_size").alias("year"),
        F.col("p_retailprice").alias("artist_latitude"),
        (-F.col("p_retailprice")).alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_size").alias("duration"),
        F.col("p_type").alias("a"),
        F.lit("x").alias("b"),
        F.lit("y").alias("c"),
    ).write.partitionBy("a", "b", "c").json(f"{base}/song_data")
    return read_song_metadata(spark, base)


# Filter and dimensions


def filter_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.filter_page(s.table(spark, sf_dir, "events"), s.PURCHASE, "event_type")


def dim_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = s.fanout_metadata(s.table(spark, sf_dir, "part"))
    return dims.songs_dim(metadata.withColumn("song_id", F.col("title")))


def dim_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.artists_dim(s.fanout_metadata(s.table(spark, sf_dir, "part")))


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.users_dim(s.order_log(s.table(spark, sf_dir, "orders")))


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(dims.time_dim(s.event_log(spark, sf_dir)))


# Fact


def fact_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(s.LinearStar(spark, sf_dir).fact)


def fact_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = reports.song_plays_of_matches(s.fanout_matches(spark, sf_dir))
    return plays.groupBy("song_id").agg(F.sum("plays").alias("plays"))


def fact_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = s.LinearStar(spark, sf_dir).numbered_fact
    return ids.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("songplay_id").alias("n_ids"),
        (F.min("songplay_id") >= 0).alias("non_negative"),
    )


# Reports


def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = s.LinearStar(spark, sf_dir)
    return reports.top_songs(star.song_plays, star.songs, star.artists)


def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = s.LinearStar(spark, sf_dir)
    return reports.top_artists(star.song_plays, star.songs, star.artists)


def top_artists_by_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = s.LinearStar(spark, sf_dir)
    return reports.top_artists_by_plays(star.song_plays, star.artists)


def free_paid_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.free_paid_ratio(dim_users(spark, sf_dir))


# Counts, views and catalogue


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.table_counts(s.LinearStar(spark, sf_dir).tables)


def view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the five tables and of the filtered log, counted through SQL over their views."""
    star = s.LinearStar(spark, sf_dir)
    names = {table: f"playlake_{uuid4().hex}_{table}" for table in (*audit.LABELS, "log_data")}
    register_views({names[table]: frame for table, frame in (star.tables | {"log_data": star.log}).items()})
    labels = {label: names[table] for table, label in audit.LABELS.items()}
    counts = _count_by_sql(spark, labels | {"Log:": names["log_data"]})
    for name in names.values():  # the plan has taken the views in
        spark.catalog.dropTempView(name)
    return counts


def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, folders = _write_linear_tables(spark, sf_dir)[1:]
    names = register_tables(spark, folders, prefix=f"playlake_{uuid4().hex}_")
    try:
        labels = [audit.LABELS[table] for table in folders]
        return stage(_count_by_sql(spark, dict(zip(labels, names))), f"{work}/counts")
    finally:
        drop_tables(spark, names)


def catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per song by SQL over registered tables, joined on the stored ids."""
    work, folders = _write_linear_tables(spark, sf_dir)[1:]
    names = register_tables(spark, folders, prefix=f"playlake_{uuid4().hex}_")
    table = dict(zip(folders, names))
    try:
        joined = spark.sql(
            f"""SELECT s.artist_id, s.year, s.title, count(*) AS plays
                FROM {table['song_plays']} p
                JOIN {table['songs']} s ON p.song_id = s.song_id AND p.artist_id = s.artist_id
                GROUP BY s.artist_id, s.year, s.title"""
        )
        return stage(joined, f"{work}/joined")
    finally:
        drop_tables(spark, names)


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    recorded, _, folders = _write_linear_tables(spark, sf_dir)
    rows = [(audit.LABELS[table], written.rows, written.checksum) for table, written in recorded.items()]
    written = {t: spark.read.schema(TABLE_SCHEMAS[t]).parquet(path) for t, path in folders.items()}
    return audit.reconcile_counts(
        spark.createDataFrame(rows, job.SUMS_SCHEMA), audit.table_sums(written, PARTITION_COLUMNS)
    )


def _write_linear_tables(
    spark: SparkSession, sf_dir: str
) -> tuple[dict[str, sinks.Written], str, dict[str, str]]:
    """What was written of each table, the work folder, and the tables' folders."""
    star = s.LinearStar(spark, sf_dir)
    folders = {table: f"{star.work}/out/{table}" for table in audit.LABELS}

    def write(table: str) -> sinks.Written:
        frame = star.numbered_fact if table == "song_plays" else star.tables[table]
        if table not in PARTITION_COLUMNS:
            return sinks.write_table(frame, folders[table])
        staged = stage(frame, f"{star.work}/{table}_staged")
        return sinks.write_partitioned(staged, folders[table], PARTITION_COLUMNS[table])

    star.tables  # build the plans once, before they are written side by side
    written = together(spark, *[lambda table=table: write(table) for table in folders])
    return dict(zip(folders, written)), star.work, folders


def _count_by_sql(spark: SparkSession, relations: dict[str, str]) -> DataFrame:
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{label}' AS label, count(*) AS n FROM {relation}"
            for label, relation in relations.items()
        )
    )


# Sinks


def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark)
    songs = stage(dims.songs_dim(s.fanout_metadata(s.table(spark, sf_dir, "part"))), f"{work}/staged")
    sinks.write_partitioned(songs, f"{work}/songs", PARTITION_COLUMNS["songs"])
    return spark.read.schema(TABLE_SCHEMAS["songs"]).parquet(f"{work}/songs")


def parquet_partitioned_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark)
    times = stage(dims.time_dim(s.order_log(s.table(spark, sf_dir, "orders"))), f"{work}/staged")
    sinks.write_partitioned(times, f"{work}/time", PARTITION_COLUMNS["time"])
    return without_zone(spark.read.schema(TABLE_SCHEMAS["time"]).parquet(f"{work}/time"))


def parquet_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    customer = s.table(spark, sf_dir, "customer")
    for _ in range(2):  # the second write replaces the first
        sinks.write_table(customer, path)
    return spark.read.schema(customer.schema).parquet(path)


def csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    sinks.write_csv(table_counts(spark, sf_dir), path, header=False)
    return spark.read.schema("label STRING, n BIGINT").csv(path)


def csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    sinks.write_csv(top_songs(spark, sf_dir), path, header=True)
    return spark.read.schema("message STRING").option("header", True).csv(path)


# The whole job, from JSON


# Folders of finished runs, by application and input; with what the input's files looked like.
_RUNS: dict[tuple[str, str], tuple[list, str]] = {}
_RUNNING = Lock()


def run_job(spark: SparkSession, sf_dir: str) -> str:
    """Write the linear star as JSON, run the job on it and return the output folder.

    An application runs the job once for all queries that read its outputs, as long as the files of the
    input keep their names, sizes and times.
    """
    key = spark.sparkContext.applicationId, sf_dir
    with _RUNNING:
        files = file_states(spark, [f"{sf_dir}/{name}.parquet" for name in ("orders", "customer", "nation")])
        before, out = _RUNS.get(key, (None, None))
        if before != files or not exists(spark, out):
            star = s.LinearStar(spark, sf_dir)
            star.write_inputs(f"{star.work}/in")
            out = f"{star.work}/out"
            job.run(spark, f"{star.work}/in", out)
            _RUNS[key] = files, out
    return out


def etl_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_job(spark, sf_dir)
    schema = "label STRING, recorded BIGINT, written BIGINT, status STRING"
    return spark.read.schema(schema).option("header", True).csv(f"{out}/reconciliation")


def etl_song_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_job(spark, sf_dir)
    plays = spark.read.schema(TABLE_SCHEMAS["song_plays"]).parquet(f"{out}/song_plays")
    return without_zone(plays.drop("songplay_id"))


def etl_table(table: str) -> Query:
    """A table that the job writes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        written = spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{run_job(spark, sf_dir)}/{table}")
        return without_zone(written) if "start_time" in written.columns else written

    return query


def etl_report(folder: str, schema: str, header: bool = True) -> Query:
    """A report that the job writes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.schema(schema).option("header", header).csv(f"{run_job(spark, sf_dir)}/{folder}")

    return query


def plays_in_utc(query: Query) -> Query:
    """The given tables hold UTC times without a zone."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(utc_session(spark), sf_dir)

    return run


_ALL: dict[str, Query] = {
    query.__name__: query
    for query in (
        json_scan,
        json_scan_songs,
        filter_page,
        dim_songs,
        dim_artists,
        dim_users,
        dim_time,
        fact_plays,
        fact_fanout,
        fact_row_id,
        top_songs,
        top_artists,
        top_artists_by_plays,
        free_paid_ratio,
        table_counts,
        view_counts,
        catalog_counts,
        catalog_join,
        reconcile_counts,
        parquet_partitioned,
        parquet_partitioned_time,
        parquet_plain,
        csv_counts,
        csv_report,
        etl_reconciliation,
        etl_song_plays,
    )
} | {
    "etl_songs": etl_table("songs"),
    "etl_artists": etl_table("artists"),
    "etl_users": etl_table("users"),
    "etl_time": etl_table("time"),
    "etl_top_songs": etl_report("top_songs", "message STRING"),
    "etl_top_artists": etl_report("top_artists", "message STRING"),
    "etl_top_artists_by_plays": etl_report("top_artists_by_plays", "message STRING"),
    "etl_ratio": etl_report(
        job.RATIO_FOLDER, "label STRING, free_users STRING, paid_users STRING, ratio STRING"
    ),
    "etl_counts": etl_report(job.COUNTS_FOLDER, "label STRING, n BIGINT", header=False),
}

QUERIES = {name: plays_in_utc(query) for name, query in _ALL.items()}
