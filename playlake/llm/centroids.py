"""Clustering around centroids, each vector's nearest one found by the threshold algorithm.

Every dimension has a list of the centroids sorted by their component. From a vector's own value the list is walked
outwards, nearer entry first. A centroid that turns up for the first time gets its exact distance. The squared
distances of the entries that come next, summed over the dimensions, bound all centroids not yet seen from below;
a vector is done as soon as this sum strictly exceeds its best distance, so that none that ties is missed.

All numbers are integers. A task adds up its vectors per centroid, so what is shuffled in a round are sums.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import stage
from playlake.scratch import discard, scratch_dir

SCALE = 256.0
DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
# Vectors that walk the lists together.
TOGETHER = 512
# Components below this are computed in 64 bits if the squares of their differences fit. Others are Python's integers.
SMALL = 1 << 27
# More than any difference of small components; marks the end of a list.
FAR = 1 << 29

SUMS_SCHEMA = "cluster INT, dim INT, n BIGINT, total DECIMAL(38,0)"
ASSIGNED_SCHEMA = "vec_id BIGINT, cluster INT, distance BIGINT"


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector takes part: it has `dims` components, none of them null or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    seed: int = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector that takes part.

    Vectors that are null, have another length, or hold a null or a component that is not finite take no part. Components x
    become floor(256 * x), distances are squared Euclidean, ties go to the smaller number. The first
    centroids are the vectors whose `<seed>:<id>` has the smallest SHA-256; equal ids, which have equal hashes, are taken by
    smaller vector, and null ids come last. With fewer vectors than `centroids` each is one. A centroid without vectors
    stays. Rows that repeat an id are vectors of their own. Other columns are not read. An empty table gives no rows.
    Numbers are exact at any size; a distance or an inertia beyond a BIGINT, or a sum of 39 digits, stops the job.
    """
    spark = vectors.sparkSession
    work = scratch_dir(spark)
    points = stage(
        vectors.where(usable(F.col(vector_col), dims)).select(
            F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
        ),
        f"{work}/points",
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = points.orderBy(digest.asc_nulls_last(), "vector").limit(centroids).select("vector").collect()
    found = [[int(np.floor(SCALE * x)) for x in row["vector"]] for row in first]
    for _ in range(rounds if found else 0):
        sums = points.mapInArrow(_sums(found), SUMS_SCHEMA).groupBy("cluster", "dim")
        # One row per centroid and dimension.
        for row in sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            found[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]

    assigned = stage(points.mapInArrow(_assigned(found), ASSIGNED_SCHEMA), f"{work}/assigned")
    discard(spark, f"{work}/points")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    totals = {row["cluster"]: int(row["total"]) for row in per_cluster.collect()}
    rows = [(c, n, sum(totals.values()), _digest(found[c])) for c, n in totals.items()]
    # One row per centroid.
    told = spark.createDataFrame(rows, "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


class Lists:
    """The centroids sorted by each of their components."""

    def __init__(self, centroids: list[list[int]]):
        exact = np.array(centroids, dtype=object)
        fits = exact.shape[1] * (2 * SMALL) ** 2 < 1 << 63
        self.small = bool(fits and (np.abs(exact) < SMALL).all())
        self.centroids = exact.astype(np.int64) if self.small else exact
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(self.centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each whole vector, given as doubles."""
        if self.small and (np.abs(vectors) < SMALL).all():
            return self._walk(vectors.astype(np.int64), self.centroids, self.values, FAR)
        exact = np.array([[int(x) for x in v] for v in vectors], dtype=object)
        exact = exact.reshape(len(vectors), self.centroids.shape[1])
        return self._walk(exact, self.centroids.astype(object), self.values.astype(object), float("inf"))

    def _walk(self, vectors, centroids, values, far):
        n, dims = vectors.shape
        k = len(centroids)
        cluster = np.full(n, k, dtype=np.int64)
        best = np.zeros(n, dtype=vectors.dtype)
        seen = np.zeros((n, k), dtype=bool)
        below = np.column_stack([np.searchsorted(values[:, d], vectors[:, d]) for d in range(dims)]) - 1
        above = below + 1
        every = np.arange(dims)
        rows = np.arange(n)
        while len(rows):
            x, low, high = vectors[rows], below[rows], above[rows]
            gap_low = np.where(low >= 0, x - values[np.maximum(low, 0), every], far)
            gap_high = np.where(high < k, values[np.minimum(high, k - 1), every] - x, far)
            # One step outwards in every dimension, on the nearer side. Lists all have the same centroids, so they end together
            # at the latest, and a row whose lists end has seen all of them.
            go_low = gap_low <= gap_high
            entry = self.order[np.where(go_low, np.maximum(low, 0), np.minimum(high, k - 1)), every]
            fresh = np.zeros((len(rows), k), dtype=bool)
            fresh[np.arange(len(rows))[:, None], entry] = True
            fresh &= ~seen[rows]
            seen[rows] |= fresh
            at, centroid = np.nonzero(fresh)
            exact = ((x[at] - centroids[centroid]) ** 2).sum(axis=1)
            self._improve(cluster, best, rows[at], centroid, exact, k)
            low = low - go_low
            high = high + ~go_low
            below[rows], above[rows] = low, high
            left = ~seen[rows].all(axis=1)
            rows, x, low, high = rows[left], x[left], low[left], high[left]
            gap_low = np.where(low >= 0, x - values[np.maximum(low, 0), every], far)
            gap_high = np.where(high < k, values[np.minimum(high, k - 1), every] - x, far)
            frontier = (np.minimum(gap_low, gap_high) ** 2).sum(axis=1)
            rows = rows[~(frontier > best[rows])]
        return cluster, best

    @staticmethod
    def _improve(cluster, best, rows, centroid, distance, none) -> None:
        """Take over what is nearer, or as near with a smaller number; `rows` ascend."""
        if not len(rows):
            return
        order = np.lexsort((centroid, distance, rows)) if distance.dtype != object else np.array(
            sorted(range(len(rows)), key=lambda i: (rows[i], distance[i], centroid[i]))
        )
        rows, centroid, distance = rows[order], centroid[order], distance[order]
        first = np.r_[True, rows[1:] != rows[:-1]]
        rows, centroid, distance = rows[first], centroid[first], distance[first]
        unset = cluster[rows] == none
        nearer = distance < best[rows]
        tie = (distance == best[rows]) & (centroid < cluster[rows])
        take = unset | nearer.astype(bool) | tie.astype(bool)
        cluster[rows[take]], best[rows[take]] = centroid[take], distance[take]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows at a time and their vectors, scaled and rounded down, as doubles."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            values = some.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield some, np.floor(SCALE * values).reshape(some.num_rows, -1)


def _sums(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        dims = len(centroids[0])
        n = [0] * len(centroids)
        totals = np.zeros((len(centroids), dims), dtype=object)
        for _, vectors in _whole(batches):
            cluster, _ = lists.nearest(vectors)
            small = (np.abs(vectors) < SMALL).all()
            exact = vectors.astype(np.int64) if small else np.array([[int(x) for x in v] for v in vectors], dtype=object)
            for c in np.unique(cluster):
                mine = exact[cluster == c]
                n[c] += len(mine)
                totals[c] += mine.sum(axis=0).astype(object)
        rows = [(c, d, n[c], totals[c][d]) for c in range(len(centroids)) if n[c] for d in range(dims)]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "dim", "n", "total"])

    return run


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids) if centroids else None
        for some, vectors in _whole(batches):
            cluster, distance = lists.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance.tolist(), pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run
