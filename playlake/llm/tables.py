"""Reading the given tables, and joins of rows to per-key results that survive hot keys."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake import scratch

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

# A key with more than this share of all rows is hot, so there can be at most 1 / share hot keys.
HOT_SHARE = 1 / 1000


# Rows that Python gets at a time. Texts are long: at Spark's own 10,000 a batch and its copies take a
# good part of a worker's memory, which the worker then keeps.
BATCH_ROWS = 1000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand BATCH_ROWS rows at most to Python at a time; the setting is put back."""
    before = spark.conf.get(ROWS_SETTING)
    spark.conf.set(ROWS_SETTING, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(ROWS_SETTING, before)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as Parquet, in small batches where Python takes part, and return the written table."""
    with small_batches(df.sparkSession):
        return scratch.stage(df, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def id_and_bytes(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`doc_id`, a BIGINT, and `body`, the UTF-8 bytes of the text; a null text is empty.

    Only these two columns go on, so further columns cannot clash with those of an operator.
    """
    return documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    )


def attach(rows: DataFrame, lookup: DataFrame, key: str, count: str, share: float = HOT_SHARE) -> DataFrame:
    """Inner join of `rows` to `lookup`, which has one row per `key` and in `count` its rows in `rows`.

    Rows of hot keys find their partner in a broadcast of those keys and are not shuffled. There
    are at most 1 / `share` of them, by arithmetic and at every size of the input. All others are
    shuffled, and none of their keys holds more than `share` of all rows. Both sides are read
    twice, so they should be stored tables.
    """
    total = F.broadcast(lookup.agg((F.sum(count) * F.lit(share)).alias("hot_from")))
    split = lookup.join(total, F.lit(True), "left")
    hot = F.broadcast(split.where(F.col(count) > F.col("hot_from")).drop("hot_from"))
    rest = split.where(F.col(count) <= F.col("hot_from")).drop("hot_from")
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))
