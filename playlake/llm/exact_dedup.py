"""Exact duplicates by recipes of content-defined chunks.

A text is cut where a rolling hash of its bytes says so, so equal texts are cut alike. Each
distinct chunk moves through one shuffle, in which all chunks of one hash are compared byte by byte.
That makes the hash a verified identifier; where several chunks share a hash, their rank among these
is added to it. From then on a text is its recipe, the list of its chunk identifiers, and texts are
equal exactly if their recipes are. Long texts are never compared or moved again.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm.tables import attach, id_and_bytes, stage
from playlake.scratch import scratch_dir

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
# A cut is made where the top CUT_BITS bits of the rolling hash are zero, but no chunk is shorter
# than MIN_CHUNK bytes, unless it ends the text, or longer than MAX_CHUNK bytes.
CUT_BITS = 10
MIN_CHUNK = 256
MAX_CHUNK = 8192
# One random number per byte value, by rule.
GEAR = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)],
    dtype=np.uint32,
)
# Chunk bytes that a task gathers before it hands them on.
BATCH_BYTES = 8_000_000

RECIPE_SCHEMA = "doc_id BIGINT, n_points BIGINT, text_sha256 STRING, recipe ARRAY<BIGINT>"


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of `data`."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    rolling = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for span in (1, 2, 4, 8):  # sums over 16 bytes, by doubling
        rolling[span:] += rolling[:-span] << np.uint32(span)
    ends, start = [], 0
    for at in [*(np.flatnonzero(rolling >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist(), n]:
        while at - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if at - start >= MIN_CHUNK or at == n and at > start:
            ends.append(at)
            start = at
    return ends


def chunks(body: bytes, hash_bits: int) -> tuple[bytes, list[tuple[int, bytes]]]:
    """The normalised text and its (hash, chunk) pairs."""
    data = body.translate(None, BLANKS)
    out, start, drop = [], 0, 64 - hash_bits
    for end in cuts(data):
        chunk = data[start:end]
        # Signed, as Spark's long is.
        out.append(((xxhash.xxh3_64_intdigest(chunk) >> drop) - (1 << 63 >> drop), chunk))
        start = end
    return data, out


def exact_dedup(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64
) -> DataFrame:
    """One row per row of `documents`: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are equal if identical without blanks (space, and tab to carriage return). Of equal texts
    the one with the most code points stays, then the one with the smallest id; a null id counts as
    the largest. A null text is empty; empty and blank texts form one group. Rows repeated with
    their id form one group too, of which each has kept true if its id and length are the ones that
    stay. Other columns are not read. An empty table gives no rows.

    `hash_bits` shortens the chunk hash, to test what happens when chunks share one.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    texts = id_and_bytes(documents, id_col, text_col)
    recipes = stage(texts.mapInArrow(_recipes(hash_bits), RECIPE_SCHEMA), f"{work}/recipes")
    distinct = texts.mapInArrow(_chunk_bytes(hash_bits), "hash BIGINT, chunk BINARY").distinct()
    shared = stage(
        distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"),
        f"{work}/shared",
    )
    if not shared.isEmpty():
        recipes = _with_ranks(spark, texts, recipes, distinct, shared, hash_bits, work)
    first = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id"))
    groups = stage(
        recipes.groupBy("recipe")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "recipe",
            F.col("first.doc_id").alias("keep_id"),
            (-F.col("first.col1")).alias("keep_points"),
            "group_size",
        ),
        f"{work}/groups",
    )
    return attach(recipes, groups, "recipe", "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"),
    )


def _recipes(hash_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, digests, lists = [], [], []
            for body in batch.column("body"):
                body = body.as_py()
                data, parts = chunks(body, hash_bits)
                points.append(len(body.decode()))
                digests.append(hashlib.sha256(data).hexdigest())
                lists.append(np.array([h for h, _ in parts], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(points, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_points", "text_sha256", "recipe"],
            )

    return run


def _chunk_bytes(hash_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, bytes]] = set()
        held = 0

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.int64()), pa.array([c for _, c in found], pa.binary())],
                names=["hash", "chunk"],
            )
            found.clear()
            return out

        for batch in batches:
            for body in batch.column("body"):
                for part in chunks(body.as_py(), hash_bits)[1]:
                    if part not in found:
                        found.add(part)
                        held += len(part[1])
                if held > BATCH_BYTES:
                    held = 0
                    yield give()
        if found:
            yield give()

    return run


def _with_ranks(
    spark: SparkSession,
    texts: DataFrame,
    recipes: DataFrame,
    distinct: DataFrame,
    shared: DataFrame,
    hash_bits: int,
    work: str,
) -> DataFrame:
    """Recipes with each chunk named by its hash and its rank among the chunks of that hash."""
    order = Window.partitionBy("hash").orderBy("chunk")
    ranks = stage(
        distinct.join(shared, "hash", "left_semi").withColumn("rank", F.row_number().over(order).cast("bigint")),
        f"{work}/ranks",
    )
    named = (
        texts.mapInArrow(_chunk_places(hash_bits), "text_sha256 STRING, place BIGINT, hash BIGINT, chunk BINARY")
        .join(ranks, ["hash", "chunk"], "left")
        .groupBy("text_sha256")
        .agg(
            F.sort_array(F.collect_set(F.struct("place", "hash", F.coalesce("rank", F.lit(0).cast("bigint")).alias("rank")))).alias("parts")
        )
        .select("text_sha256", F.flatten(F.transform("parts", lambda p: F.array(p["hash"], p["rank"]))).alias("named"))
    )
    empty = F.array().cast("array<bigint>")
    return stage(
        recipes.drop("recipe")
        .join(named, "text_sha256", "left")
        .select("doc_id", "n_points", "text_sha256", F.coalesce("named", empty).alias("recipe")),
        f"{work}/named",
    )


def _chunk_places(hash_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column("body"):
                data, parts = chunks(body.as_py(), hash_bits)
                digest = hashlib.sha256(data).hexdigest()
                rows += [(digest, i, h, c) for i, (h, c) in enumerate(parts)]
            digests, places, hashes, bodies = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.string()),
                    pa.array(places, pa.int64()),
                    pa.array(hashes, pa.int64()),
                    pa.array(bodies, pa.binary()),
                ],
                names=["text_sha256", "place", "hash", "chunk"],
            )

    return run
