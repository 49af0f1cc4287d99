"""Quality by importance resampling.

Two generative models of hashed n-grams are counted: one of target text, one of all raw text. A
document's weight is the ratio of its probabilities under the two. Gumbel noise, drawn from the id, is
added to the log weight, and the top k documents are kept: a draw without replacement in proportion to
the weights.
"""

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import id_and_bytes, small_batches, stage
from playlake.scratch import scratch_dir

# Hashed n-grams share this many buckets. The two models are this long, whatever the corpus.
BUCKETS = 1 << 16
# Numbers of groups of buckets, from coarse to single ones, and the counts by which one leans on the one before.
GROUPS = (1 << 10, 1 << 13, BUCKETS)
PRIOR = 100.0
# At most so many target documents are counted: those whose ids have the smallest hashes.
TARGET_DOCUMENTS = 20_000
# The noise is this much smaller than a plain Gumbel draw. Close to zero only clear cases are left to
# the weights alone; at 1 the draw is in proportion to the weights.
TEMPERATURE = 0.05
# How many times better raw text must explain a document than target text does, for it to be rejected.
REJECT_ODDS = 100.0
# Words whose hashes a worker remembers.
REMEMBERED = 300_000

MIX = np.uint64(0x9E3779B97F4A7C15)
# Runs of one kind of character, and what stands for them in the shape of a word.
SHAPES = (
    (re.compile(rb"[A-Z]+"), b"A"),
    (re.compile(rb"[a-z\x80-\xff]+"), b"a"),
    (re.compile(rb"[0-9]+"), b"0"),
)


class _Hashes(dict):
    """Hash of a word, and of its shape in the other half, worked out once per word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        shape = word
        for run, sign in SHAPES:
            shape = run.sub(sign, shape)
        value = xxhash.xxh32_intdigest(word.lower()) | xxhash.xxh32_intdigest(shape, 1) << 32
        self[word] = value
        return value


HASHES = _Hashes()


def features(body: bytes) -> np.ndarray:
    """Buckets of the n-grams of a text: words and pairs of words, shapes and pairs of shapes."""
    words = body.split()
    both = np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    found = []
    for kind, single in enumerate((both & np.uint64(0xFFFFFFFF), both >> np.uint64(32))):
        pair = single[:-1] * np.uint64(0xD6E8FEB86659FD93) + single[1:] + np.uint64(1)
        for n, gram in enumerate((single, pair)):
            found.append((gram + np.uint64(1 + 2 * kind + n << 40)) * MIX >> np.uint64(48))
    return np.concatenate(found).astype(np.int64)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket, from counts.

    Counts of few target documents say little about a bucket, so its ratio leans on the one of the group of
    buckets around it, and that on a larger group, by PRIOR expected counts each.
    """
    share = (raw + 1) / (raw.sum() + BUCKETS)
    ratio = np.ones(1)
    for groups in GROUPS:
        counted = target.reshape(groups, -1).sum(axis=1)
        expected = share.reshape(groups, -1).sum(axis=1) * target.sum()
        ratio = (counted + PRIOR * np.repeat(ratio, groups // len(ratio))) / (expected + PRIOR)
    return np.log(ratio)


def fit(texts: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """Log ratio per bucket. `target_ids` must be of bounded size: it is broadcast."""
    flagged = texts.join(F.broadcast(target_ids.withColumn("target", F.lit(True))), "doc_id", "left")
    counts = (
        flagged.mapInArrow(_count, "bucket INT, target BIGINT, raw BIGINT")
        .groupBy("bucket")
        .agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    )
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    with small_batches(texts.sparkSession):
        rows = counts.collect()  # one row per bucket at most
    for bucket, in_target, in_raw in rows:
        target[bucket], raw[bucket] = in_target, in_raw
    return log_ratio(target, raw)


def weigher(ratio: Broadcast) -> Callable[[Column], Column]:
    """Function of the text bytes: n_features and log_weight."""

    @F.pandas_udf("n_features BIGINT, log_weight DOUBLE")
    def weigh(bodies: pd.Series) -> pd.DataFrame:
        sizes, weights = [], []
        for body in bodies:
            found = features(body)
            sizes.append(len(found))
            weights.append(float(ratio.value[found].sum()))
        return pd.DataFrame({"n_features": sizes, "log_weight": weights})

    return weigh


def target_sample(labels: DataFrame, id_col: str, is_target: Column, limit: int) -> DataFrame:
    """Distinct ids of the target rows of `labels`: the `limit` ones with the smallest hashes."""
    ids = labels.where(is_target & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id")).distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def kth_largest(keys: DataFrame, key: str, k: int, bins: int = 4096) -> float:
    """The exact kth largest of a column; minus infinity if there are not so many.

    The driver sees one row per bin and round. The bin that holds the answer is cut into bins again,
    until only equal keys are left in it.
    """
    low, high, count = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if k > count:
        return float("-inf")
    if k <= 0:
        return float("inf")
    while low < high:
        share = (F.col(key) - low) / (high - low)
        counted = (
            keys.where(F.col(key).between(low, high))
            .groupBy(F.floor(share * bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
            .collect()
        )
        for row in sorted(counted, key=lambda r: -r["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def resample(
    documents: DataFrame,
    target_ids: DataFrame,
    keep: int | None = None,
    carry: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row per row: document (a struct of the carried columns, all by default), n_features, log_weight,
    sample_key, kept.

    `target_ids` (doc_id) names the target documents; it must be of bounded size. `sample_key` is the log
    weight plus Gumbel noise times `temperature`, drawn from the id; the `keep` largest are kept, and all
    that tie with the last of them. Without `keep`, as many are kept as there are documents that raw text
    explains less than REJECT_ODDS times as well as target text does.

    A null or empty text has no n-grams and weight 0. A null id is never a target and draws like any
    other id; rows with equal ids draw alike. An empty table gives no rows; without target documents
    the models agree and all weights are 0.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    ratio = spark.sparkContext.broadcast(fit(id_and_bytes(documents, id_col, text_col), target_ids))
    carried = F.struct(*[F.col(f"`{c}`") for c in carry or documents.columns])
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), F.col(id_col)), 11).cast("double") + 0.5) / float(1 << 53)
    gumbel = -F.ln(-F.ln(unit))
    weighed = documents.select(
        carried.alias("document"), gumbel.alias("gumbel"), weigher(ratio)(body).alias("weight")
    ).select(
        "document",
        "weight.n_features",
        "weight.log_weight",
        (F.col("weight.log_weight") + F.col("gumbel") * temperature).alias("sample_key"),
    )
    weighed = stage(weighed, f"{work}/weighed")
    if keep is None:
        keep = weighed.where(F.col("log_weight") > -math.log(REJECT_ODDS)).count()
    least = kth_largest(weighed, "sample_key", keep)
    return weighed.withColumn("kept", F.col("sample_key") >= F.lit(least))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    target, raw = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for is_target, body in zip(batch.column("target").to_pylist(), batch.column("body")):
            counts = np.bincount(features(body.as_py()), minlength=BUCKETS)
            raw += counts
            if is_target:
                target += counts
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(target[seen]), pa.array(raw[seen])],
        names=["bucket", "target", "raw"],
    )
