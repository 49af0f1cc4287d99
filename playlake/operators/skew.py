"""Equi-join that spreads the keys holding the most rows, on either side or of the output, over many tasks.

Which keys these are is read off a summary of each side: the most frequent keys with upper bounds of their rows, and one
bound for all others. It comes from frequent-items sketches, which keep a bounded number of counters per task and are merged
in executors, so no key travels if none is hot. Only keys that the summaries cannot clear are counted.
Keys are told by a 64-bit hash; two that share one are cut alike, which changes no result.
"""

from dataclasses import dataclass, replace
from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from playlake.parallel import SHUFFLE_PARTITIONS, together
from playlake.scratch import discard, scratch_dir, stage

# Output rows per task. Adaptive execution sizes tasks by what they read; with many matches per
# row they write far more than that.
TASK_ROWS = 5_000_000
# A key is cut into pieces far smaller than a task, so that tasks, which get theirs by a hash, are about alike. A
# piece joins at most CELL rows of one side with CELL rows of the other.
PIECES_PER_TASK = 32
CELL = isqrt(TASK_ROWS // PIECES_PER_TASK)
# A key is hot if it has more rows, on a side or in the output, than a piece, and more than one of this many parts of all.
# So at most three times as many are hot, by arithmetic: 24 bytes each are what the driver sees and broadcasts.
MAX_HOT = 100_000
# Counters of a sketch, and keys that are read off it.
TRACKED = 500_000
FREQUENT = 10_000
# Sketches of so many groups of tasks are merged side by side.
MERGED = 32

KEY = "key_hash"


@dataclass(frozen=True)
class Summary:
    """Rows per key on one side of a join, as far as a sketch tells."""

    rows: int
    # About how many keys there are.
    keys: float
    # Upper bounds of the rows of the most frequent keys, by hash, and of those of any other key.
    frequent: dict[int, int]
    rest: int

    def of(self, key: int) -> int:
        return self.frequent.get(key, self.rest)

    def times(self, n: int) -> "Summary":
        """If every row stands for at most `n`."""
        return replace(self, rows=self.rows * n, frequent={k: v * n for k, v in self.frequent.items()}, rest=self.rest * n)


def unique(rows: int) -> Summary:
    """A side that has one row per key."""
    return Summary(rows, rows, {}, 1)


def key_hash(keys: list[str]) -> Column:
    """The hash of the key; null if a part of it is, as such a row joins nothing."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return F.when(known, F.xxhash64(*keys))


def summarise(df: DataFrame, *key_lists: list[str]) -> list[Summary]:
    """Summaries of `df` by several keys, in one pass that reads the keys only.

    Sketches are merged in executors and not in the driver, which would get one from every task.
    """
    hashes = [key_hash(keys).alias(f"h{i}") for i, keys in enumerate(key_lists)]
    group = F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("merged_by")
    parts, whole = [], []
    for i in range(len(key_lists)):
        parts += [
            F.count(f"h{i}").alias(f"n{i}"),
            F.expr(f"approx_top_k_accumulate(h{i}, {TRACKED})").alias(f"f{i}"),
            F.hll_sketch_agg(f"h{i}").alias(f"d{i}"),
        ]
        whole += [
            F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}"),
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(f{i}), {FREQUENT})").alias(f"f{i}"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")), F.lit(0)).alias(f"d{i}"),
        ]
    # Grouped, as sketches of no rows cannot be combined; no rows give no group.
    row = df.select(*hashes, group).groupBy("merged_by").agg(*parts).groupBy(F.lit(True)).agg(*whole).first()
    if row is None:
        return [Summary(0, 0, {}, 0) for _ in key_lists]
    out = []
    for i in range(len(key_lists)):
        rows = row[f"n{i}"]
        frequent = {e["item"]: e["count"] for e in row[f"f{i}"] or [] if e["item"] is not None}
        # A sketch with a counter for each row is exact. Else it can be off by 3.5 rows in as many as it has places,
        # a third more than counters, and leaves out keys within twice that.
        rest = 0 if rows <= TRACKED else int(5.25 * rows / TRACKED) + 1
        if len(row[f"f{i}"] or []) >= FREQUENT:
            rest = max(rest, min(frequent.values()))
        out.append(Summary(rows, row[f"d{i}"], frequent, rest))
    return out


def summarise_counts(counts: DataFrame, keys: list[str], rows: str) -> Summary:
    """The summary of a side of which `counts` has the rows of each key."""
    seen = Observation()
    counted = counts.observe(seen, F.sum(rows).alias("rows"), F.count(F.lit(1)).alias("keys"))
    most = counted.select(key_hash(keys).alias(KEY), F.col(rows).alias("n")).where(F.col(KEY).isNotNull())
    most = [(r[KEY], r["n"]) for r in most.orderBy(F.desc("n"), KEY).limit(FREQUENT).collect()]
    total = seen.get
    return Summary(total["rows"] or 0, total["keys"], dict(most), most[-1][1] if len(most) == FREQUENT else 0)


@dataclass
class KeySizes:
    """Rows per key on both sides of a join: summaries, and the rows to count where those do not tell.

    `left_rows` and `right_rows` have the hash of the key and in `n` the rows that one of theirs stands for.
    """

    left: Summary
    right: Summary
    left_rows: DataFrame
    right_rows: DataFrame
    # Rows of the output, if they are known.
    output_rows: int | None = None

    def output(self) -> float:
        """About the rows of the output."""
        if self.output_rows is not None:
            return self.output_rows
        both = self.left.frequent.keys() | self.right.frequent.keys()
        known = sum(self.left.of(k) * self.right.of(k) for k in both)
        others = [max(0, side.rows - sum(side.frequent.values())) for side in (self.left, self.right)]
        keys = max(1, max(self.left.keys, self.right.keys) - len(both))
        return known + others[0] * others[1] / keys

    def suspects(self, most: dict[str, float]) -> list[int] | None:
        """Hashes of keys that may be hot; None if any key may be."""

        def hot(left: int, right: int) -> bool:
            return left > most["left_rows"] or right > most["right_rows"] or left * right > most["output_rows"]

        if hot(self.left.rest, self.right.rest):
            return None
        return [
            k for k in self.left.frequent.keys() | self.right.frequent.keys() if hot(self.left.of(k), self.right.of(k))
        ]

    def exact(self, only: list[int] | None) -> DataFrame:
        """Rows of the keys, or of some of them, on both sides; 0 for a side that lacks the key."""
        sides = []
        for side, name in ((self.left_rows, "left_rows"), (self.right_rows, "right_rows")):
            if only is not None:
                some = side.sparkSession.createDataFrame([(k,) for k in only], f"{KEY} BIGINT")
                side = side.join(F.broadcast(some), KEY, "left_semi")
            sides.append(side.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.sum("n").alias(name)))
        return sides[0].join(sides[1], KEY, "full_outer").fillna(0, ["left_rows", "right_rows"])


def rows_of(df: DataFrame, keys: list[str], rows: Column | None = None) -> DataFrame:
    """The rows that each row of `df` stands for, by hash of its key."""
    n = (F.lit(1) if rows is None else rows).cast("bigint").alias("n")
    return df.select(key_hash(keys).alias(KEY), n)


def key_sizes(left: DataFrame, right: DataFrame, keys: list[str]) -> KeySizes:
    """Both sides summarised; they are read for it, so they should be stored tables."""
    [of_left], [of_right] = together(
        left.sparkSession, lambda: summarise(left, keys), lambda: summarise(right, keys)
    )
    return KeySizes(of_left, of_right, rows_of(left, keys), rows_of(right, keys))


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_spread: list[str],
    right_spread: list[str],
    sizes: KeySizes,
    cell: int | None = None,
    by_key: bool = False,
) -> DataFrame:
    """Inner join on `keys`, with each hot key cut into a grid of slices.

    If the summaries in `sizes` show that no key is hot, this is a plain join. Else the keys they suspect are counted,
    and all keys only if they can rule out none. Rows of a hot key that the other side lacks are dropped before the
    shuffle. Otherwise a left row goes to one slice of the left side and is copied to all slices of
    the right side, and the other way round, so each matching pair meets exactly once. Slices are
    hashes of the `*_spread` columns and not random numbers: a task that runs again after a lost
    executor must send each row to the same place.

    With `by_key`, the output comes in the order of the keys within each task, whatever the size of `right`.
    """
    cell = cell or CELL
    spark = left.sparkSession
    totals = {"left_rows": sizes.left.rows, "right_rows": sizes.right.rows, "output_rows": sizes.output()}
    suspects = sizes.suspects(hot_from(cell, totals))
    rows = []
    if suspects is None:
        rows, totals = _counted(sizes, cell)
    elif suspects:
        rows = _hot_keys(sizes.exact(suspects), cell, totals).collect()
    left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    if rows:
        hot = F.broadcast(spark.createDataFrame(rows, HOT_SCHEMA))
        left_cut = any(row["left_slices"] > 1 for row in rows)
        right_cut = any(row["right_slices"] > 1 for row in rows)
        left = _sliced(left, hot, keys, left_spread, "left", "right", copied=right_cut)
        right = _sliced(right, hot, keys, right_spread, "right", "left", copied=left_cut)
        # A slice that is the same for all rows would be folded away, and the rows be dealt once more for the join.
        keys = [*keys, *["left_slice"] * left_cut, *["right_slice"] * right_cut]
    tasks = int(totals["output_rows"] // TASK_ROWS)
    if tasks > int(spark.conf.get(SHUFFLE_PARTITIONS)):
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.join(right.hint("merge") if by_key else right, keys).drop("left_slice", "right_slice")


HOT_SCHEMA = f"{KEY} BIGINT, matched BOOLEAN, left_slices BIGINT, right_slices BIGINT"


def _counted(sizes: KeySizes, cell: int) -> tuple[list, dict[str, float]]:
    """The hot keys among all, and the rows of both sides and of the output."""
    spark = sizes.left_rows.sparkSession
    work = scratch_dir(spark)
    seen = Observation()
    output = F.col("left_rows").cast("double") * F.col("right_rows")
    counted = sizes.exact(None).withColumn("output_rows", output)
    names = ("left_rows", "right_rows", "output_rows")
    counted = stage(counted.observe(seen, *[F.sum(c).alias(c) for c in names]), work)
    totals = {c: seen.get[c] or 0 for c in names}
    rows = _hot_keys(counted, cell, totals).collect()
    discard(spark, work)
    return rows, totals


def hot_from(cell: int, totals: dict[str, float]) -> dict[str, float]:
    """Rows on a side and of the output beyond which a key is hot."""
    return {c: max(cell * cell, n / MAX_HOT) for c, n in totals.items()}


def _hot_keys(sizes: DataFrame, cell: int, totals: dict[str, float]) -> DataFrame:
    """The hot keys, with whether both sides have them and the number of slices each side is cut into."""
    most = hot_from(cell, totals)
    sizes = sizes.withColumn("output_rows", F.col("left_rows").cast("double") * F.col("right_rows"))

    def slices(own: str, other: str) -> Column:
        by_output = F.col(own).cast("double") * F.least(F.col(other), F.lit(cell)) / (cell * cell)
        return F.greatest(F.ceil(by_output), F.ceil(F.col(own) / (cell * cell)), F.lit(1).cast("bigint"))

    return sizes.where(" OR ".join(f"{c} > {float(n)!r}D" for c, n in most.items())).select(
        KEY,
        ((F.col("left_rows") > 0) & (F.col("right_rows") > 0)).alias("matched"),
        slices("left_rows", "right_rows").alias("left_slices"),
        slices("right_rows", "left_rows").alias("right_slices"),
    )


def _sliced(
    df: DataFrame, hot: DataFrame, keys: list[str], spread: list[str], own: str, other: str, copied: bool
) -> DataFrame:
    """Add both slice columns; rows are only `copied` if some key has several slices on the other side."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    own_slice = F.coalesce(F.pmod(F.xxhash64(*spread), F.col(f"{own}_slices")), zero)
    slices = F.coalesce(F.col(f"{other}_slices"), one)
    other_slice = F.explode(F.sequence(zero, slices - 1)) if copied else zero
    found = df.withColumn(KEY, key_hash(keys)).join(hot, KEY, "left").where(F.coalesce("matched", F.lit(True)))
    return found.select(
        *df.columns, own_slice.alias(f"{own}_slice"), other_slice.alias(f"{other}_slice")
    )
