"""Exact top-k search by inner product with a vector-approximation file.

The index holds, block by block, each vector's quantised cells and, in a column of their own, the exact
vectors. A first scan reads cells only. A cell bounds each component from both sides, so it bounds
the score, and the kth best lower bound is a score that the answer must reach. The second scan reads
exact vectors, best bound first, of the cells that can still reach it, until the next bound falls below
the kth best exact score. Queries and index meet block by block.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.scratch import scratch_dir, stage

SCALE = 256.0
CELL_BITS = 6
BLOCK = 2048
QUERY_BLOCK = 256
# Exact vectors read at a time.
READ = 64
# Below this every sum is an integer that a double holds exactly.
EXACT = 2.0**53
# Bounds of larger scores can be off by this share of the sum of absolute products, for each component.
SLACK = 2.0**-50
# Beyond this not even a double can hold the sums.
MOST = 1e150

INDEX_SCHEMA = (
    "block BIGINT, dims INT, ids BINARY, cells BINARY, low BINARY, width BINARY, exact BINARY"
)
QUERY_SCHEMA = "query_dims INT, query_ids BINARY, query BINARY, needed BINARY"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell_bits: int = CELL_BITS,
) -> DataFrame:
    """The `k` best rows for each query row: query_id, rank, vec_id, score.

    Components x become floor(256 * x); the score is the integer inner product. Rows with the
    query's own id are not its candidates. Equal scores go to the smaller id. With fewer candidates all
    are returned. Vectors that are null or empty, hold a null or a component that is not finite, or
    have a null id take no part; vectors of different lengths never meet. Ids should be unique: if they are
    not, each row is a candidate and the smallest vector of an id is its query. Scores that a double may not hold
    exactly are computed in Python's integers; one among the best that does not fit a BIGINT stops the job. Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    work = scratch_dir(spark)
    used = (
        vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        .select(
            F.col(id_col).cast("bigint").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            is_query.alias("asked"),
        )
    )
    index = stage(used.select("vec_id", "vector").mapInArrow(_blocks(cell_bits), INDEX_SCHEMA), f"{work}/index")
    asked = used.where("asked").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stage(asked, f"{work}/asked")
    cells = index.drop("exact")

    blind = asked.withColumn("needed", F.lit(None).cast("bigint"))
    bounds = _meet(cells, blind).mapInArrow(_lower_bounds(k), "vec_id BIGINT, bounds ARRAY<BIGINT>")
    # The kth best of the bounds that the tasks found; null if there are fewer than k.
    best = F.sort_array(F.flatten(F.collect_list("bounds")), asc=False)
    needed = stage(
        bounds.groupBy("vec_id").agg(F.get(best, F.lit(k - 1)).alias("needed")), f"{work}/needed"
    )
    informed = asked.join(needed, "vec_id", "left")
    found = _meet(index, informed).mapInArrow(_exact(k), "query_id BIGINT, vec_id BIGINT, score BIGINT")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _meet(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of queries with every block of the index: the stated queries against all rows."""
    return index.crossJoin(queries.mapInArrow(_query_blocks, QUERY_SCHEMA))


def whole(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, ids and integer vectors of a batch, for each length of vectors in it."""
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    column = batch.column("vector")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    out = []
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        scaled = np.floor(SCALE * values[starts[rows][:, None] + np.arange(dims)])
        if not np.abs(scaled).max() < MOST:
            raise ValueError("components are too large for exact scores")
        out.append((rows, ids[rows], scaled))
    return out


def _packed(whole_numbers: np.ndarray) -> np.ndarray:
    """As integers of 4 bytes if they fit, and else as doubles."""
    return whole_numbers.astype(np.int32) if np.abs(whole_numbers).max() < 2**31 else whole_numbers


def _unpacked(packed: bytes, rows: int, dims: int) -> np.ndarray:
    kind = np.int32 if len(packed) == 4 * rows * dims else np.float64
    return np.frombuffer(packed, dtype=kind).reshape(rows, dims)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of `rows` at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            if sum(b.num_rows for b in held) >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)
                held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)


def _blocks(cell_bits: int):
    cells_per_dim = 1 << cell_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in _gathered(batches, BLOCK):
            for _, ids, exact in whole(batch):
                low = exact.min(axis=0)
                width = np.ceil((exact.max(axis=0) - low + 1) / cells_per_dim)
                # The quotient of large numbers may be rounded up.
                cells = np.minimum((exact - low) // width, cells_per_dim - 1).astype(np.uint16)
                row = [number, exact.shape[1], ids, cells, low, width, _packed(exact)]
                yield _row(row, INDEX_SCHEMA)
                number += 1

    return run


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _gathered(batches, QUERY_BLOCK):
        needed = np.array([-(2**62) if n is None else n for n in batch.column("needed").to_pylist()], dtype=np.float64)
        for rows, ids, vectors in whole(batch):
            yield _row([vectors.shape[1], ids, _packed(vectors), needed[rows]], QUERY_SCHEMA)


def _row(values: list, schema: str) -> pa.RecordBatch:
    columns, names = [], []
    for value, field in zip(values, schema.split(", ")):
        name, kind = field.split()
        names.append(name)
        if kind == "BINARY":
            columns.append(pa.array([np.ascontiguousarray(value).tobytes()], pa.binary()))
        else:
            columns.append(pa.array([value], pa.int64() if kind == "BIGINT" else pa.int32()))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    """Index block and query block of each row, if their vectors have one length."""
    for batch in batches:
        for row in batch.to_pylist():
            dims = row["dims"]
            if dims != row["query_dims"]:
                continue
            low, width = np.frombuffer(row["low"]), np.frombuffer(row["width"])
            cells = np.frombuffer(row["cells"], dtype=np.uint16).reshape(-1, dims)
            query = _unpacked(row["query"], len(row["query_ids"]) // 8, dims).astype(np.float64)
            # From each cell's lower corner, a score can rise by `rise` and fall by `fall`.
            corner = query @ (low + cells * width).T
            ids = np.frombuffer(row["ids"], dtype=np.int64)
            query_ids = np.frombuffer(row["query_ids"], dtype=np.int64)
            corner[query_ids[:, None] == ids] = -np.inf
            rise = np.maximum(query, 0) @ (width - 1)
            fall = np.minimum(query, 0) @ (width - 1)
            most = np.abs(query) @ (np.abs(low) + (cells.max(axis=0) + 1) * width)
            large = most >= EXACT
            slack = np.where(large, np.abs(query).sum(axis=1) + SLACK * (dims + 8) * most, 0)
            rise, fall = rise + slack, fall - slack
            yield (
                {"ids": ids, "corner": corner, "exact": row.get("exact"), "large": large},
                {"ids": query_ids, "vectors": query, "rise": rise, "fall": fall, "needed": row["needed"]},
            )


def _lower_bounds(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for block, queries in _pairs(batches):
            corner = block["corner"]
            most = min(k, corner.shape[1])
            top = np.partition(corner, corner.shape[1] - most, axis=1)[:, -most:] + queries["fall"][:, None]
            for query, bounds in zip(queries["ids"].tolist(), top):
                # Bounds that a BIGINT does not hold are left out, or lowered.
                bounds = np.minimum(bounds[bounds > -(2.0**62)], 2.0**62)
                held = np.concatenate([best.get(query, bounds[:0]), bounds])
                best[query] = np.sort(held)[-k:]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(best), pa.int64()),
                pa.array([np.floor(b).astype(np.int64) for b in best.values()], pa.list_(pa.int64())),
            ],
            names=["vec_id", "bounds"],
        )

    return run


def _exact(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # For each query its k best so far, as (-score, id), and the score to reach.
        best: dict[int, list[tuple[int, int]]] = {}
        for block, queries in _pairs(batches):
            exact = _unpacked(block["exact"], len(block["ids"]), queries["vectors"].shape[1])
            needed = np.frombuffer(queries["needed"])
            upper = block["corner"] + queries["rise"][:, None]
            for i, query in enumerate(queries["ids"].tolist()):
                held = best.setdefault(query, [])
                reach = max(needed[i], -held[-1][0] if len(held) == k else -np.inf)
                order = np.flatnonzero(upper[i] >= reach)
                order = order[np.argsort(-upper[i][order], kind="stable")]
                for at in range(0, len(order), READ):
                    some = order[at : at + READ]
                    if len(held) == k and upper[i][some[0]] < -held[-1][0]:
                        break
                    some = some[upper[i][some] > -np.inf]
                    if block["large"][i]:
                        vector = [int(x) for x in queries["vectors"][i]]
                        scores = [-sum(int(x) * y for x, y in zip(row, vector)) for row in exact[some]]
                    else:
                        scores = (-(exact[some] @ queries["vectors"][i])).astype(np.int64).tolist()
                    held += zip(scores, block["ids"][some].tolist())
                    held.sort()
                    del held[k:]
        rows = [(query, vec, -score) for query, held in best.items() for score, vec in held]
        if any(not -(2**63) <= score < 2**63 for *_, score in rows):
            raise ValueError("components are too large for exact scores")
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
        )

    return run
