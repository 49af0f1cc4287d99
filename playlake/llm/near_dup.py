"""Near duplicates by a chosen-path set similarity join.

Documents are sets of word shingles; equal sets are one class from the start. Each of several
independent trees branches the classes by chosen minwise tokens: a node goes on to the classes that share
the smallest shingle under a hash function that its path chooses, one or two functions per node, on
average one over the similarity. A node is compared exhaustively once it is small, or once branching no longer
makes it much smaller, for then its members are alike. A pair that meets in several nodes is compared in one,
and every link is confirmed on the full sets.

Large nodes are cut into blocks, so no task holds a whole node. Each block is compared within itself and with
a few representatives of the node, which connects most members of an alike node at once. Then only the
members outside a node's largest component meet its other blocks, for only what is not connected yet can matter.
"""

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm.components import components
from playlake.llm.tables import attach, id_and_bytes, stage
from playlake.scratch import scratch_dir

SHINGLE = 5
# Documents are linked from PERCENT of intersection to union on.
PERCENT = 75
FUNCTIONS = 64
# A pair at the threshold shares a node of one level in about 0.81 of the trees.
TREES = 12
EXTRA_EVERY = 3
SMALL = 64
# A node that keeps this share of its parent is not branched any further.
DENSE = 0.5
LEVELS = 10
# Blocks in which large nodes are compared.
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 250_000
# Members of a large node that meet all its blocks.
REPRESENTATIVES = 4
# Marks by which texts that the second round does not need are told before they are shuffled.
MARKS = 1 << 17
# Pairs that agree in fewer functions are not looked at: at the threshold that is 1 pair in 10^8.
AGREE = 28
REMEMBERED = 300_000
SIGN_BYTES = 2_000_000

FACTORS = np.array(
    [
        int.from_bytes(hashlib.blake2b(f"minwise {j}".encode(), digest_size=8).digest(), "little") | 1
        for j in range(FUNCTIONS)
    ],
    dtype=np.uint64,
)
SETS_SCHEMA = "doc_id BIGINT, n_shingles BIGINT, set_hash BINARY, sketch ARRAY<INT>"
LINKS_SCHEMA = "a BIGINT, b BIGINT"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORDS = _WordHashes()


def shingles(body: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text, which stand for them."""
    words = body.lower().split()
    h = np.fromiter(map(WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(words))
    if size == 0:
        return h
    factor = np.uint64(0x9E3779B97F4A7C15)
    joined = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        joined = joined * factor + h[i : len(h) - size + 1 + i]
        joined ^= joined >> np.uint64(29)
    return np.unique(joined * np.uint64(0xBF58476D1CE4E5B9))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest shingle of each non-empty set under each function, as 32 bits."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    every = np.concatenate(sets)
    out = np.empty((len(sets), FUNCTIONS), dtype=np.uint32)
    for j, factor in enumerate(FACTORS):
        out[:, j] = np.minimum.reduceat(every * factor, starts) >> np.uint64(32)
    return out.view(np.int32)


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept.

    Words are what stands between blanks (space, and tab to carriage return), with A to Z lower-cased. A
    text of fewer words than a shingle has one shingle, all of it. Documents are linked if at least
    PERCENT percent of the shingles of both together are in both; a component is what links reach, and is
    named by its smallest id, which is the one kept. A null, empty or blank text has no shingle and is
    linked with nothing. A row with a null id takes no part: its component is null and it is kept. Ids
    should be unique: rows repeated with their text are one, but of rows with equal ids and different texts either
    text may be the one that is compared. Other columns are not read. An
    empty table gives no rows.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    texts = id_and_bytes(documents, id_col, text_col)
    sets = stage(texts.mapInArrow(_sign, SETS_SCHEMA), f"{work}/sets")
    classes = stage(
        sets.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_hash")
        .agg(
            F.min("doc_id").alias("class"),
            F.count(F.lit(1)).alias("n"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        ),
        f"{work}/classes",
    )
    nodes = _leaves(classes, trees, work)
    roots = _roots(texts, classes, nodes, work)
    named = classes.join(roots, F.col("class") == F.col("node"), "left").select(
        "set_hash", "n", F.coalesce("root", "class").alias("component_id")
    )
    named = stage(named, f"{work}/named")
    taking_part = sets.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "n_shingles", "set_hash")
    alone = sets.where("doc_id IS NULL OR n_shingles = 0")
    found = attach(taking_part, named, "set_hash", "n").select("doc_id", "n_shingles", "component_id")
    found = found.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, sets, held = [], [], 0
        for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
            body = body.as_py()
            docs.append(doc)
            sets.append(shingles(body))
            held += len(body)
            if held > SIGN_BYTES:
                yield _signed(docs, sets)
                docs, sets, held = [], [], 0
        if docs:
            yield _signed(docs, sets)


def _signed(docs: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [i for i, s in enumerate(sets) if len(s)]
    sketch: list = [None] * len(sets)
    if full:
        for i, row in zip(full, sketches([sets[i] for i in full])):
            sketch[i] = row
    digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(docs, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(sketch, pa.list_(pa.int32())),
        ],
        names=["doc_id", "n_shingles", "set_hash", "sketch"],
    )


def _leaves(classes: DataFrame, trees: int, work: str) -> DataFrame:
    """node, class, of the nodes that are to be compared exhaustively; each set of members once."""
    spark = classes.sparkSession
    first = []
    for tree in range(trees):
        chosen = [tree] + ([trees + tree // EXTRA_EVERY] if tree % EXTRA_EVERY == 0 else [])
        first += [_child(F.lit(tree).cast("bigint"), F.lit(c % FUNCTIONS)) for c in chosen]
    everything = F.lit(1 << 62).cast("bigint")
    children = classes.select("class", "n_shingles", F.explode(F.array(*first)).alias("node"))
    children = children.withColumn("parent_n", everything)
    leaves = []
    for level in range(LEVELS):
        rows = stage(children, f"{work}/level{level}")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("parent_n").alias("parent"))
        sizes = stage(sizes.where("n > 1").select("node", "n", "parent"), f"{work}/sizes{level}")
        is_leaf = F.col("n") <= SMALL
        if level:
            is_leaf |= F.col("n") >= F.col("parent") * DENSE
        if level == LEVELS - 1:
            is_leaf = F.lit(True)
        members = attach(rows, sizes, "node", "n").select("node", "class", "n_shingles", "n", is_leaf.alias("leaf"))
        leaves.append(members.where("leaf").drop("leaf"))
        if sizes.where(~is_leaf).isEmpty():
            break
        going_on = members.where("NOT leaf").select("node", "class", "n_shingles", F.col("n").alias("parent_n"))
        # One or two functions, chosen by the path.
        functions = F.when(
            F.pmod(F.xxhash64(F.lit("extra"), "node"), F.lit(EXTRA_EVERY)) == 0,
            F.array(_choice("first"), _choice("second")),
        ).otherwise(F.array(_choice("first")))
        going_on = going_on.withColumn("function", F.explode(functions))
        children = going_on.join(classes.select("class", "sketch"), "class").select(
            "class", "n_shingles", _child(F.col("node"), F.col("function")).alias("node"), "parent_n"
        )
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    every = stage(every, f"{work}/leaves")
    # Nodes with the same members are one; members are compared by their number, extremes and hashes.
    alike = every.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("class").alias("low"),
        F.max("class").alias("high"),
        F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("mix"),
        F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("mix2"),
        F.sum("n_shingles").alias("shingles"),
        *[F.min_by("class", F.xxhash64(F.lit(r), "class")).alias(f"r{r}") for r in range(REPRESENTATIVES)],
    )
    chosen = F.array(*[f"r{r}" for r in range(REPRESENTATIVES)])
    once = alike.groupBy("n", "low", "high", "mix", "mix2").agg(
        F.min("node").alias("node"), F.first("shingles").alias("shingles"), F.first(chosen).alias("chosen")
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    once = stage(once.select("node", "n", blocks.cast("int").alias("blocks"), "chosen"), f"{work}/nodes")
    return attach(every.drop("n"), once, "node", "n").select(
        "node", "class", "n", "blocks", F.array_contains("chosen", F.col("class")).alias("represents")
    )


def _choice(name: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(name), "node"), F.lit(FUNCTIONS)).cast("int")


def _child(path: Column, function: Column) -> Column:
    """Name of the node that a class goes to from `path` by one function."""
    return F.xxhash64(path, function, F.get(F.col("sketch"), function))


def _roots(texts: DataFrame, classes: DataFrame, nodes: DataFrame, work: str) -> DataFrame:
    """node, root of the components that exhaustive comparison of each node gives."""
    nodes = stage(nodes, f"{work}/members")
    own = F.pmod(F.xxhash64("class", "node"), F.col("blocks")).cast("int")
    places = nodes.select("node", "class", F.col("class").alias("root"), own.alias("block"), "blocks", "represents")

    def within(place: Column) -> Column:
        met = F.when(place["represents"], F.sequence(F.lit(0), place["blocks"] - 1)).otherwise(F.array(place["block"]))
        return F.transform(met, lambda b: _slot(b, b))

    roots = components(_links(texts, classes, places, within, f"{work}/within"))
    apart = _apart(nodes.where("blocks > 1"), roots, work)
    if apart.isEmpty():
        return roots

    def across(place: Column) -> Column:
        others = F.sequence(F.lit(0), place["other_blocks"] - 1)
        mains = F.sequence(-place["main_blocks"], F.lit(-1))
        block = place["block"]
        return F.when(block < 0, F.transform(others, lambda o: _slot(block, o))).otherwise(
            F.concat(
                F.transform(mains, lambda m: _slot(m, block)),
                F.transform(others, lambda o: _slot(F.least(o, block), F.greatest(o, block))),
            )
        )

    # At most MARKS rows, at any size of the input.
    needed = F.broadcast(apart.select(_mark("class").alias("mark")).distinct())
    some = texts.withColumn("mark", _mark("doc_id")).join(needed, "mark", "left_semi").drop("mark")
    more = _links(some, classes, apart, across, f"{work}/across")
    return components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _mark(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(MARKS))


def _slot(i: Column, j: Column) -> Column:
    return F.struct(i.alias("i"), j.alias("j"))


def _apart(members: DataFrame, roots: DataFrame, work: str) -> DataFrame:
    """Members of the nodes that are not one component yet, in new blocks.

    Those of the largest component have blocks below 0 and meet only the others, whose blocks are from 0 on.
    """
    roots = roots.select(F.col("node").alias("class"), "root")
    named = members.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = stage(named.select("node", "class", "root", "n", "blocks"), f"{work}/named_members")
    # All members of a node have the same `n` and `blocks`.
    parts = named.groupBy("node", "root").agg(
        F.count(F.lit(1)).alias("part"), F.first("n").alias("n"), F.first("blocks").alias("blocks")
    )
    split = parts.groupBy("node").agg(
        F.max("part").alias("main_n"), F.max_by("root", "part").alias("main"), F.first("n").alias("n"),
        F.first("blocks").alias("blocks"),
    )

    def share(part: Column) -> Column:
        return F.ceil(part * F.col("blocks") / F.col("n")).cast("int")

    split = stage(
        split.where("n > main_n").select(
            "node",
            "n",
            "main",
            share(F.col("main_n")).alias("main_blocks"),
            share(F.col("n") - F.col("main_n")).alias("other_blocks"),
        ),
        f"{work}/split",
    )
    hashed = F.xxhash64("class", "node")
    block = F.when(F.col("root") == F.col("main"), -1 - F.pmod(hashed, F.col("main_blocks")))
    block = block.otherwise(F.pmod(hashed, F.col("other_blocks"))).cast("int")
    return attach(named.drop("n", "blocks"), split, "node", "n").select(
        "node", "class", "root", block.alias("block"), "main_blocks", "other_blocks"
    )


def _links(
    texts: DataFrame, classes: DataFrame, places: DataFrame, slots: Callable[[Column], Column], path: str
) -> DataFrame:
    """Links between classes that meet in a slot and do not share a root, as far as they connect more.

    `places` are node, class, root, block and what else `slots` needs to name the (i, j) of a place.
    """
    rows = _meetings(texts, classes, places, slots, path)
    rows = rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    return stage(rows.mapInArrow(_compare, LINKS_SCHEMA), f"{path}/links")


def _meetings(
    texts: DataFrame, classes: DataFrame, places: DataFrame, slots: Callable[[Column], Column], path: str
) -> DataFrame:
    """One row with body and sketch for every slot in which a class takes part."""
    place = F.struct(*[c for c in places.columns if c != "class"])
    of_class = places.groupBy("class").agg(
        F.sort_array(F.collect_list("node")).alias("nodes"), F.collect_list(place).alias("places")
    )
    of_class = stage(of_class.join(classes.select("class", "sketch"), "class"), f"{path}/places")
    bodies = texts.join(of_class, F.col("doc_id") == F.col("class")).drop("doc_id")
    return (
        bodies.withColumn("place", F.explode("places"))
        .withColumn("slot", F.explode(slots(F.col("place"))))
        .select("place.node", "slot.i", "slot.j", "place.block", "class", "body", "sketch", "nodes", "place.root")
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("node", "i", "j", "block", "class", "body")

    def rows() -> Iterator[tuple]:
        for batch in batches:
            small = [batch.column(c).to_pylist() for c in names]
            sketch = batch.column("sketch").flatten().to_numpy(zero_copy_only=False).reshape(-1, FUNCTIONS)
            lists = batch.column("nodes")
            yield from zip(*small, sketch, lists, batch.column("root").to_pylist())

    held: list[tuple[int, int]] = []
    for (node, i, j), members in groupby(rows(), key=itemgetter(0, 1, 2)):
        held += compare_node(node, i, j, list({m[4]: m for m in members}.values()))
        if len(held) > 50_000:
            yield _link_batch(held)
            held = []
    yield _link_batch(held)


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def compare_node(node: int, i: int, j: int, members: list[tuple]) -> list[tuple[int, int]]:
    """Stars of the components among members of two blocks of a node, or of one if `i` is `j`.

    Members that share a root are connected already.
    """
    count = len(members)
    if count < 2:
        return []
    classes = [m[4] for m in members]
    sketch = np.stack([m[6] for m in members])
    block = np.array([m[3] for m in members])
    group = np.unique([m[8] for m in members], return_inverse=True)[1]
    agree = np.zeros((count, count), dtype=np.uint8)
    for f in range(FUNCTIONS):
        agree += sketch[:, None, f] == sketch[None, :, f]
    if i != j:
        agree[block[:, None] == block[None, :]] = 0
    agree[group[:, None] == group[None, :]] = 0
    # Pairs that also meet in a node with a smaller name are compared there.
    earlier: dict[int, list[int]] = {}
    for index, m in enumerate(members):
        for name in m[7].as_py():
            if name < node:
                earlier.setdefault(name, []).append(index)
    for met in earlier.values():
        if len(met) > 1:
            agree[np.ix_(met, met)] = 0
    left, right = np.nonzero(np.triu(agree >= AGREE, 1))
    if not len(left):
        return []
    order = np.argsort(-agree[left, right].astype(np.int16), kind="stable")
    left, right = left[order], right[order]
    sets: dict[int, np.ndarray] = {}

    def full(index: int) -> np.ndarray:
        if index not in sets:
            sets[index] = shingles(members[index][5])
        return sets[index]

    links = []
    for at in range(0, len(left), 2000):
        a, b = left[at : at + 2000], right[at : at + 2000]
        apart = group[a] != group[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            if group[x] != group[y] and linked(full(x), full(y)):
                low, high = sorted((group[x], group[y]))
                group[group == high] = low
                links.append((x, y))
    # Every member that was linked, joined to the smallest class of its group.
    smallest: dict[int, int] = {}
    for index in sorted({k for link in links for k in link}, key=classes.__getitem__):
        smallest.setdefault(int(group[index]), index)
    out = []
    for index in {k for link in links for k in link}:
        low = smallest[int(group[index])]
        if low != index:
            out.append((classes[low], classes[index]))
    return out


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < PERCENT * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)
