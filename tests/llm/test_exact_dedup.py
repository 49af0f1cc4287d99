import hashlib
import re

import pytest

from playlake.llm.exact_dedup import CUT_BITS, MAX_CHUNK, MIN_CHUNK, cuts, exact_dedup

LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(3000))
TEXTS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (4, None), (5, ""), (6, " \n"), (7, LONG), (8, LONG.replace(" ", "  ")),
    (9, LONG + "x"), (10, "ab"), (10, "ab"), (None, "ab"), (11, "é b"), (12, "e b"), (13, "a b"),
]
SCHEMA = "doc_id BIGINT, text STRING"


def expected(rows):
    groups = {}
    for doc, text in rows:
        text = text or ""
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text), []).append((doc, len(text)))
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        digest = hashlib.sha256(key.encode()).hexdigest()
        out += [(doc, best[0], len(members), (doc, size) == best, digest) for doc, size in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_bits", [64, 2])
def test_equals_brute_force_also_when_chunks_share_hashes(spark, hash_bits):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    got = exact_dedup(df, hash_bits=hash_bits).drop("n_chunks").collect()
    assert sorted(map(tuple, got), key=str) == expected(TEXTS)


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    more = ", recipe STRING, hash STRING, body STRING, n_points STRING, group_size STRING"
    df = spark.createDataFrame([(1, "a", *"vwxyz"), (2, "a ", *"vwxyz")], SCHEMA + more)
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()}
    assert rows == {1: (2, 2, False), 2: (2, 2, True)}


def test_cuts_follow_content_and_keep_their_sizes():
    data = hashlib.shake_256(b"x").digest(200_000)
    ends = cuts(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert sum(sizes) == len(data)
    assert all(MIN_CHUNK <= s <= MAX_CHUNK for s in sizes[:-1])
    assert abs(len(data) / len(sizes) - MIN_CHUNK - (1 << CUT_BITS)) < 300
    moved = cuts(b"some bytes in front" + data)
    assert len({e - 19 for e in moved} & set(ends)) > 0.9 * len(ends)
    assert cuts(b"") == [] and cuts(b"a") == [1]
    assert [b - a for a, b in zip([0, *cuts(b"a" * 30_000)], cuts(b"a" * 30_000))][0] in (MIN_CHUNK, MAX_CHUNK)


def test_hot_group_is_not_joined_by_shuffle(spark):
    rows = [(i, "same") for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 9000)]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 9000 and sum(r.kept for r in got) == 6001
    assert {r.group_size for r in got if r.doc_id < 3000} == {3000}


def test_ids_of_another_integer_type(spark):
    rows = [(5, "a b"), (6, "ab"), (7, None)]
    wide, narrow = (exact_dedup(spark.createDataFrame(rows, f"doc_id {kind}, text STRING")) for kind in ("BIGINT", "INT"))
    assert sorted(wide.collect()) == sorted(narrow.collect())
    assert len({r.keep_id for r in wide.collect()}) == 2
