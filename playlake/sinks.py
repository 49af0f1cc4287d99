"""Parquet and CSV writers. Every writer replaces its target, when the new one is complete, and tells what it wrote."""

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from playlake.operators.audit import checksum
from playlake.publish import publish
from playlake.scratch import discard, scratch_dir, stage

# Of plain tables. Row ids of the fact are most of its bytes, and take a third of what they do with Spark's default.
COMPRESSION = "zstd"
# How a partitioned write is cut into tasks. Opening a folder costs as much as so many rows.
ROWS_PER_TASK = 1_000_000
FOLDERS_PER_TASK = 50
# Folders of up to this part of a task are dealt together, others by themselves.
PIECES_PER_TASK = 8
# Where a partitioned table lists its folders and their rows. Names that begin like this are not read as data.
FOLDER_LIST = "_folders"


@dataclass(frozen=True)
class Written:
    rows: int
    # Of the rows of a table, in any order.
    checksum: Decimal | None = None


def write_table(df: DataFrame, path: str) -> Written:
    df, written = _counted(df)
    publish(df.sparkSession, path, lambda aside: df.write.mode("overwrite").parquet(aside, compression=COMPRESSION))
    return Written(**written.get)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> Written:
    """Write one folder per value of `columns`. `df` should be a stored table: it is read twice.

    The rows of each folder are counted first, and the list is kept with the table.
    """
    spark = df.sparkSession
    work = scratch_dir(spark)
    folders = stage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), work)
    rows, written = _counted(deal(df, folders, columns), columns)

    def write(aside: str) -> None:
        rows.write.mode("overwrite").partitionBy(*columns).parquet(aside)
        folders.write.parquet(f"{aside}/{FOLDER_LIST}")

    publish(spark, path, write)
    discard(spark, work)
    return Written(**written.get)


def deal(df: DataFrame, folders: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in partitions that write the folders, none of more than twice ROWS_PER_TASK rows.

    `folders` has the rows of each folder in `n`. Pieces are laid end to end, and one that begins within the nth
    ROWS_PER_TASK goes to the nth task. A large folder is a piece, cut into as many slices as its rows need by a hash of the
    whole row, so that a task that runs again gets the same ones. Small folders are pieces by ranges of their hash. So no rows are
    sampled, no folder is looked up by a shuffle, and there are at most 16 pieces per task, which is what is broadcast.
    """
    folder = F.xxhash64(*columns)
    weighed = folders.select(folder.alias("key"), (F.col("n") + ROWS_PER_TASK // FOLDERS_PER_TASK).alias("weight"))
    piece = ROWS_PER_TASK // PIECES_PER_TASK
    large, small = F.col("weight") > piece, F.col("weight") <= piece
    total, of_small = weighed.agg(F.sum("weight"), F.sum(F.when(small, F.col("weight")))).first()
    tasks = -(-(total or 0) // ROWS_PER_TASK)
    if tasks <= 1:
        return df.repartition(1)
    groups = max(1, -(-(of_small or 0) // piece))
    grouped = weighed.where(small).groupBy(F.pmod("key", F.lit(groups)).alias("key")).agg(F.sum("weight").alias("weight"))
    pieces = weighed.where(large).withColumn("whole", F.lit(True)).unionByName(grouped.withColumn("whole", F.lit(False)))
    before = Window.orderBy("whole", "key").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "whole",
        "key",
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("__start"),
        F.ceil(F.col("weight") / ROWS_PER_TASK).alias("__slices"),
        "weight",
    )
    own = pieces.where("whole").select(F.col("key").alias("__folder"), "__start", "__slices", "weight")
    own = own.withColumnRenamed("weight", "__weight")
    shared = pieces.where("NOT whole").select(F.col("key").alias("__group"), F.col("__start").alias("__first"))
    rows = df.withColumn("__folder", folder).withColumn("__group", F.pmod("__folder", F.lit(groups)))
    rows = rows.join(F.broadcast(own), "__folder", "left").join(F.broadcast(shared), "__group", "left")
    into = F.pmod(F.xxhash64(*df.columns), F.col("__slices")) * (F.col("__weight") / F.col("__slices"))
    place = F.coalesce(F.col("__start") + into, F.col("__first"))
    return rows.repartitionById(tasks, F.floor(place / ROWS_PER_TASK).cast("int")).select(*df.columns)


def write_csv(df: DataFrame, path: str, header: bool) -> Written:
    """Write a report as one CSV file, in the order of its rows."""
    written = Observation()
    df = df.coalesce(1).observe(written, F.count(F.lit(1)).alias("rows"))
    publish(df.sparkSession, path, lambda aside: df.write.mode("overwrite").option("header", header).csv(aside))
    return Written(**written.get)


def _counted(df: DataFrame, partitions: list[str] | None = None) -> tuple[DataFrame, Observation]:
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows"), checksum(df.columns, partitions or [])), written
