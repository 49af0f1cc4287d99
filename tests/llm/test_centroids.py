import hashlib

import numpy as np
import pytest

from conftest import SF_DIR
from oracle import connect, rows_of_frame, rows_of_sql
from playlake.llm.centroids import Lists, cluster
from playlake.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def brute(rows, centroids, rounds, dims, seed=2):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]))

    def order(row):
        i, v = row
        return i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v

    found = [v for _, v in sorted(kept, key=order)[:centroids]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(found))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        found = [
            [sum(v[d] for v in groups[n]) // len(groups[n]) for d in range(dims)] if n in groups else c
            for n, c in enumerate(found)
        ]
    done = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in done)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    return sorted(
        [(i, c, d, sum(e for _, e, o in done if o == c), inertia, digest[c]) for i, d, c in done], key=str
    )


def clustered(spark, rows, partitions=3, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sorted([tuple(r) for r in cluster(df, **how).collect()], key=str)


@pytest.mark.parametrize("shape", ["normal", "ties", "copies", "large"])
def test_equals_brute_force(spark, shape):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(400, 6)).astype(np.float32)
    if shape == "ties":
        values = rng.integers(-1, 2, (400, 6)).astype(np.float32) / 256
    if shape == "copies":
        values[:250] = values[0]
    if shape == "large":
        values[::50] *= 1e6
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    how = dict(centroids=7, rounds=3, dims=6)
    assert clustered(spark, rows, **how) == brute(rows, **how)


def test_distances_beyond_64_bits_in_between(spark):
    """Components of 2^30 are compared in whole numbers; the nearest distances fit."""
    rows = [(i, [float(s * 2**23 + i % 5 / 256), float(i % 3 / 256)]) for i, s in enumerate([1, -1] * 30)]
    how = dict(centroids=6, rounds=2, dims=2)
    assert clustered(spark, rows, **how) == brute(rows, **how)


@pytest.mark.parametrize("spread", [2, 5, 300, 1 << 27, 1 << 40])
def test_walk_finds_the_nearest_and_smallest_number(spread):
    rng = np.random.default_rng(spread % 97)
    for _ in range(60):
        k, dims, n = rng.integers(1, 12), rng.integers(1, 6), rng.integers(1, 40)
        centroids = rng.integers(-spread, spread, (k, dims)).tolist()
        vectors = rng.integers(-spread, spread, (n, dims))
        numbers, distances = Lists(centroids).nearest(vectors.astype(float))
        for v, c, d in zip(vectors.tolist(), numbers, distances):
            assert (d, c) == min((sum((x - y) ** 2 for x, y in zip(v, p)), i) for i, p in enumerate(centroids))


def test_walk_stops_before_all_centroids(monkeypatch):
    computed = []
    improve = Lists._improve
    monkeypatch.setattr(Lists, "_improve", staticmethod(lambda c, b, rows, *a: (computed.append(len(rows)), improve(c, b, rows, *a))))
    centroids = [[1000 * i, 1000 * i] for i in range(40)]
    Lists(centroids).nearest(np.array([[5010.0, 5020.0]]))
    assert sum(computed) < 4


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (1, [3.0, 1.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 0.0]),
            (7, [inf, 0.0]), (None, [0.5, 0.5]), (8, [-0.001, 2.0]), (None, [0.5, 0.75])]
    for centroids in (1, 3, 40):
        how = dict(centroids=centroids, rounds=5, dims=2)
        assert clustered(spark, rows, **how) == brute(rows, **how)
    assert clustered(spark, [], dims=2) == []
    assert clustered(spark, [(1, None)], dims=2) == []


def test_other_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, [0.5], "a", 3), (2, [9.0], "b", 4)], "vec_id INT, embedding ARRAY<DOUBLE>, cluster STRING, inertia INT")
    found = cluster(df, centroids=2, rounds=1, dims=1)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert {(r.vec_id, r.distance) for r in found.collect()} == {(1, 0), (2, 0)}


def test_query_equals_sql(spark):
    name = "op12_centroids"
    columns, rows = rows_of_frame(LLM_QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == rows_of_sql(connect(SF_DIR), LLM_ORACLES[name])
    assert rows
