"""Names for SQL: temp views over frames, and catalogue tables over written folders."""

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from playlake.sinks import FOLDER_LIST
from playlake.sources.schemas import PARTITION_COLUMNS, TABLE_SCHEMAS

# Folders that are registered by one statement.
PARTITIONS_AT_A_TIME = 1000


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def register_tables(spark: SparkSession, folders: dict[str, str], prefix: str = "") -> list[str]:
    """Expose written Parquet folders as external tables, with the declared columns and types.

    Types that were guessed from folder names would turn an id `007` into 7. A name that is taken is an
    error, so nobody's table is replaced; `drop_tables` takes the names away and leaves the files. Folders of a
    partitioned table are registered from the list that was kept when it was written; nothing is listed.
    """
    names = []
    try:
        for table, folder in folders.items():
            name = f"{prefix}{table}"
            partitions = PARTITION_COLUMNS.get(table)
            by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            spark.sql(
                f"CREATE TABLE {name} ({TABLE_SCHEMAS[table]}) USING parquet {by} LOCATION :folder",
                args={"folder": folder},
            )
            names.append(name)
            if partitions:
                add_partitions(spark, name, folder, partitions)
    except Exception:
        drop_tables(spark, names)
        raise
    return names


def add_partitions(spark: SparkSession, name: str, folder: str, columns: list[str]) -> None:
    """Register the folders of a written table, some at a time; the driver holds no more than these."""
    # Empty text and NULL share one folder.
    values = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    listed = spark.read.parquet(f"{folder.rstrip('/')}/{FOLDER_LIST}").select(*values).distinct().toLocalIterator()
    while some := list(islice(listed, PARTITIONS_AT_A_TIME)):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(_clauses(some, columns))}")


def _clauses(folders: list[Row], columns: list[str]) -> Iterator[str]:
    for row in folders:
        values = ", ".join(f"`{c}` = {'NULL' if row[c] is None else _quoted(row[c])}" for c in columns)
        yield f"PARTITION ({values})"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
