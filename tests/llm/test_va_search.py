import numpy as np
import pytest
from pyspark.sql import functions as F

from playlake.llm import va_search
from playlake.llm.va_search import top_k

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def brute(rows, every, k):
    use = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float))) for i, v in rows
           if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q in sorted({i for i, _ in use if i % every == 0}):
        query = min((v.tolist() for i, v in use if i == q))
        scored = sorted((-int(np.dot(query, v)), i) for i, v in use if i != q and len(v) == len(query))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def found(df, every, k, **more):
    return [tuple(r) for r in top_k(df, F.col("vec_id") % every == 0, k, **more).collect()]


@pytest.mark.parametrize("bits", [1, 4, 6])
@pytest.mark.parametrize("shape", ["normal", "ties", "hot"])
def test_equals_brute_force(spark, bits, shape):
    rng = np.random.default_rng(bits)
    values = rng.normal(size=(700, 12)).astype(np.float32)
    if shape == "ties":
        values = rng.integers(-1, 2, (700, 12)).astype(np.float32) / 4
    if shape == "hot":
        values[:300] = values[0]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert set(found(df, 25, 5, cell_bits=bits)) == brute(rows, 25, 5)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (2, [0.5, -0.001]), (4, None), (6, []), (8, [nan, 1.0]), (10, [inf, 1.0]), (12, [None, 1.0]),
            (None, [9.0, 9.0]), (14, [1.0]), (16, [2.0]), (18, [1.0, 2.0, 3.0]), (1, [3.0, 3.0]), (1, [3.0, 3.0]), (20, [-1e-9, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", block STRING, ids INT").repartition(3)
    got = sorted(found(df, 2, 2))
    assert [r for r in got if r[0] == 0] == [(0, 1, 1, 3 * 65536 + 6 * 65536), (0, 2, 1, 9 * 65536)]
    assert [r for r in got if r[0] == 14] == [(14, 1, 16, 2 * 65536)] and not [r for r in got if r[0] == 18]
    assert {r[0] for r in got} == {0, 2, 14, 16, 20}
    assert found(df.limit(0), 2, 5) == []


def test_large_components_stop(spark):
    with pytest.raises(Exception, match="too large"):
        found(spark.createDataFrame([(0, [1e30]), (1, [1.0])], SCHEMA), 1, 5)


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(5)
    exact = np.floor(256 * rng.normal(size=(2048, 64)) / 8)
    low = exact.min(axis=0)
    width = np.ceil((exact.max(axis=0) - low + 1) / (1 << va_search.CELL_BITS))
    corner = (low + (exact - low) // width * width) @ exact[0]
    rise = np.maximum(exact[0], 0) @ (width - 1)
    fall = np.minimum(exact[0], 0) @ (width - 1)
    scores = exact @ exact[0]
    assert (corner + rise >= scores).all() and (corner + fall <= scores).all()
    needed = np.sort(corner + fall)[-5]
    assert (corner + rise >= needed).sum() < 200


@pytest.mark.parametrize("top", [2.0**21, 2.0**24, 2.0**34])
def test_large_scores_are_exact(spark, top):
    rng = np.random.default_rng(8)
    values = rng.integers(-(2**22), 2**22, (300, 4)).astype(np.float32) * np.float32(top / 2**22)
    # Others are small, and some large ones differ in the last place only.
    values[:100] = rng.normal(size=(100, 4))
    if top > 2.0**30:
        values[100:, 1:] /= 2.0**30
        values[::3, 0] = 0
        values[1::3, 0] = np.abs(values[1::3, 0]) / 2.0**10
    values[200:220] = values[220:240] + [0, 0, 0, 1]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]

    def whole(v):
        return [int(np.floor(256 * x)) for x in v]

    want = set()
    for q, v in rows[::20]:
        scored = sorted((-sum(a * b for a, b in zip(whole(v), whole(w))), i) for i, w in rows if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if any(abs(s) >= 2**63 for *_, s in want):
        with pytest.raises(Exception, match="too large"):
            found(df, 20, 5)
    else:
        assert set(found(df, 20, 5)) == want and any(abs(s) >= 2**53 for *_, s in want)
