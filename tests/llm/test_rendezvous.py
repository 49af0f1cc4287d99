import math
import struct
from zlib import crc32

import xxhash
from pyspark.sql import functions as F

from playlake.llm.rendezvous import rendezvous_shards, shard_of

SCHEMA = "doc_id BIGINT, text STRING"


def test_slots_sizes_and_growth(spark):
    rows = [(i, f"text {i} é") for i in range(4000)] + [(7, "again")] * 2000 + [(None, None)] * 3 + [(9, "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", part INT, slot STRING").repartition(6)
    got = rendezvous_shards(df, [1.0] * 16, [1.0] * 17).collect()
    assert len(got) == len(rows)
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    assert 100 < sum(r.grown_shard == 16 for r in got if r.doc_id != 7) < 400
    texts = {(len((t or "").encode()) + 1, crc32((t or "").encode())) for _, t in rows}
    assert {(r.size, r.text_crc32) for r in got} == texts
    assert len({r.shard for r in got if r.doc_id == 7}) == 1 and {r.law for r in got} == {"key"}


def test_weights_decide_shares_and_lost_shards_give_up_only_their_rows(spark):
    keys = spark.range(40_000)
    shards = keys.select(
        shard_of(F.col("id"), [1, 2, 5]).alias("all"), shard_of(F.col("id"), [1, 2]).alias("fewer")
    ).collect()
    share = [sum(r["all"] == s for r in shards) / 40_000 for s in range(3)]
    assert all(abs(a - b) < 0.01 for a, b in zip(share, [1 / 8, 2 / 8, 5 / 8]))
    assert all(r["fewer"] == r["all"] for r in shards if r["all"] != 2)


def test_empty_table(spark):
    assert rendezvous_shards(spark.createDataFrame([], SCHEMA), [1.0], [1.0, 1.0]).count() == 0


def winner(key, weights):
    """The draw once more: the highest score of a weighted shard wins."""
    name = xxhash.xxh64(("null" if key is None else str(key)).encode(), seed=42).intdigest()
    scores = []
    for shard, weight in enumerate(weights):
        draw = xxhash.xxh64(struct.pack("<i", shard), seed=name).intdigest()
        scores.append((-weight / math.log(((draw >> 11) + 0.5) / 2**53), -shard))
    return -max(scores)[1]


def test_shards_equal_a_second_version_of_the_draw(spark):
    rows = [(i * 7919 - 500_000, "t") for i in range(1500)] + [(None, None), (2**62, "x")]
    weights, grown = [1.0, 2.0, 0.5, 3.0], [1.0, 2.0, 0.5, 3.0, 1.5]
    got = rendezvous_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), weights, grown).collect()
    assert {(r.doc_id, r.shard, r.grown_shard) for r in got} == {
        (i, winner(i, weights), winner(i, grown)) for i, _ in rows
    }


def test_ids_of_another_integer_type(spark):
    wide = rendezvous_shards(spark.createDataFrame([(5, "a"), (6, None)], SCHEMA), [1.0, 1.0], [1.0, 1.0, 1.0])
    narrow = rendezvous_shards(spark.createDataFrame([(5, "a"), (6, None)], "doc_id INT, text STRING"), [1.0, 1.0], [1.0, 1.0, 1.0])
    assert sorted(wide.collect()) == sorted(narrow.collect())
