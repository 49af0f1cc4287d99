"""Row counts and checksums per table and their comparison with what was written."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the count report, in its order.
LABELS = {
    "songs": "Songs:",
    "users": "Users:",
    "time": "Time:",
    "song_plays": "SongsPlays:",
    "artists": "Artists:",
}


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row (label, n) per given table."""
    counts = [
        frames[table].agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n")
        for table, label in LABELS.items()
        if table in frames
    ]
    return reduce(DataFrame.unionAll, counts)


def checksum(columns: list[str], partitions: list[str]) -> Column:
    """A sum over the rows of a table that does not depend on their order, nor on that of the columns.

    It changes with any value, and with rows that are there twice. Partition columns are stored as text, and empty
    ones as NULL.
    """
    values = [
        F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) if c in partitions else F.col(f"`{c}`") for c in sorted(columns)
    ]
    # A hash skips NULLs, so where they stand is told apart.
    row = F.xxhash64(*values, *[v.isNull() for v in values])
    return F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("checksum")


def table_sums(frames: dict[str, DataFrame], partitions: dict[str, list[str]]) -> DataFrame:
    """One row (label, n, checksum) per given table."""
    sums = [
        frames[table]
        .agg(F.count(F.lit(1)).alias("n"), checksum(frames[table].columns, partitions.get(table, [])))
        .select(F.lit(label).alias("label"), "n", "checksum")
        for table, label in LABELS.items()
        if table in frames
    ]
    return reduce(DataFrame.unionAll, sums)


def reconcile_counts(recorded: DataFrame, written: DataFrame) -> DataFrame:
    """Compare counts and checksums recorded while writing with those of the re-read tables."""
    compared = recorded.withColumnsRenamed({"n": "recorded", "checksum": "recorded_sum"}).join(
        written.withColumnsRenamed({"n": "written", "checksum": "written_sum"}), "label", "full_outer"
    )
    same = F.col("recorded").eqNullSafe(F.col("written")) & F.col("recorded_sum").eqNullSafe(F.col("written_sum"))
    return compared.select("label", "recorded", "written", F.when(same, "ok").otherwise("mismatch").alias("status"))
