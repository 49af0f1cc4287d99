"""The corpus pipeline: from raw documents to packed training sequences.

Four stages, each over all that the one before kept, which is written as Parquet and read again. All but the
last return the columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm.byte_pairs import byte_pairs
from playlake.llm.importance import TARGET_DOCUMENTS, resample, target_sample
from playlake.llm.line_dedup import line_dedup
from playlake.llm.near_dup import near_duplicates
from playlake.llm.packing import Limits, pack_texts
from playlake.llm.tables import table
from playlake.scratch import scratch_dir, stage

END_ID = 1
LIMITS = Limits(tokens=2048, segments=128, loss_tokens=2048)

# Random draws and seeded hashes have no counterpart in DuckDB; the tests hold every stage against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like those labelled as good; the rest go."""
    good = target_sample(table(spark, sf_dir, "labels"), "doc_id", F.col("quality") == 1, TARGET_DOCUMENTS)
    return resample(docs, good).where("kept").select("document.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere first; one of which nothing is left goes."""
    cleaned = line_dedup(docs).where((F.col("removed_chunks") == 0) | F.col("text").rlike(r"\S"))
    changed = F.col("removed_chunks") > 0
    values = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text")).otherwise(F.col("document.n_chars"))}
    return cleaned.select(
        *[values.get(c, F.col(f"document.`{c}`")).cast(kind).alias(c) for c, kind in docs.dtypes]
    )


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (null last).

    Rows that repeat id and text are one. One without an id has one by the hash of its text here, above 2^62.
    """
    top, low = F.lit((1 << 63) - 1), F.lit(1 << 62)
    own = F.coalesce(F.col("doc_id"), top - F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), low))
    docs = docs.withColumn("near_id", own)
    kept = near_duplicates(docs, id_col="near_id").where("kept").select(F.col("doc_id").alias("kept_id"))
    kept = docs.join(kept.hint("merge"), F.col("near_id") == F.col("kept_id"), "left_semi")
    return kept.dropDuplicates(["near_id", "text"]).drop("near_id")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the sequences they are packed into."""
    return pack_texts(docs, byte_pairs(), END_ID, LIMITS)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dup", near), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of `sf_dir`."""
    work = scratch_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"{work}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
