"""Sharding by rendezvous hashing of a stable key over weighted shards.

Every shard draws a score from a hash of the key and its own name, and the highest score wins. A new
shard only wins rows for itself, and a lost shard only gives up its own rows. Nothing has to be
remembered or looked up, so every task decides for itself.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.scratch import scratch_dir, stage

LAW = "key"


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that wins `key`; shard i has `weights[i]`. A null key is a key of its own."""
    scores = []
    for shard, weight in enumerate(weights):
        draw = F.xxhash64(F.coalesce(key.cast("string"), F.lit("null")), F.lit(shard))
        unit = (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / float(1 << 53)
        # Equal scores, should they ever happen, go to the smaller shard.
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(unit)).alias("score"), F.lit(-shard).alias("shard")))
    return (-F.array_max(F.array(*scores))["shard"]).cast("int")


def rendezvous_shards(
    documents: DataFrame,
    weights: Sequence[float],
    grown_weights: Sequence[float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `shard` is drawn over `weights` and `grown_shard` over `grown_weights`. `slot` numbers the rows of
    a shard from 0 without gaps: each task numbers its own rows of each shard, and adds how many the
    tasks before it have. So rows are not shuffled, and a shard or key with any share of the rows is
    numbered by all tasks together. A null text has size 1 and the checksum of an empty one; rows
    with equal ids, null ids included, share a shard and get slots of their own. Other columns are
    not read. An empty table gives no rows.
    """
    work = scratch_dir(documents.sparkSession)
    key = F.col(id_col).cast("bigint")
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(
        key.alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, grown_weights).alias("grown_shard"),
    )
    fields = "doc_id BIGINT, size BIGINT, text_crc32 BIGINT, shard INT, grown_shard INT, part INT, place BIGINT"
    # Written, so that rows keep their places whatever happens to executors later on.
    placed = stage(rows.mapInArrow(_places(len(weights)), fields), f"{work}/placed")
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("start") + F.col("place")).alias("slot"),
        "grown_shard",
    )


def _places(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            place = np.empty(len(shard), dtype=np.int64)
            for s in np.unique(shard):
                own = np.flatnonzero(shard == s)
                place[own] = seen[s] + np.arange(len(own))
                seen[s] += len(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(shard), part, dtype=np.int32)), pa.array(place)],
                names=[*batch.schema.names, "part", "place"],
            )

    return run
