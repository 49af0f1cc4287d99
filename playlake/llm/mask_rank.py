"""Ranked lexical search by presence masks.

An index holds, block by block, the terms of the documents with their postings. For an item the presence
bitmaps of its terms are turned into one mask per document, and the documents of a block are grouped by their
mask. A mask has a greatest possible score, the sum over its terms of the best that any document of the block has
with them. Masks are evaluated from the greatest of these scores down, until the next cannot reach the last
place of the ranking any more. A task carries the rankings of the items from block to block, so later blocks stop early.

The stated items meet all blocks of documents, in blocks of items. What is shuffled are counts of the items' terms
and at most k documents per item and task.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm.pitman_yor import squeeze, unsqueeze
from playlake.llm.tables import id_and_bytes, stage
from playlake.scratch import scratch_dir

TOP = 10
# A block is closed once it has so many tokens or documents.
BLOCK_TOKENS = 2_000_000
BLOCK_DOCS = 1 << 16
# Terms of the items that go into one block of items.
QUERY_TERMS = 50_000
# Masks evaluated in the first step; every further step of a block takes twice as many.
FIRST_MASKS = 16
# Cells of the table of presences that is turned at a time.
CELLS = 1 << 24
# Bytes of a text that are split into terms at a time.
PIECE = 1 << 20
# Rankings of so many tasks are merged at a time before the last merge.
MERGE = 64

# Weights of a term's frequency and of a document's length, as the scores are defined.
SCALE, TF, LENGTH, FLAT, SLOPE = 1_000_000_000, 1000, 8, 25, 75

# Letters and digits stay, A to Z become small, and every byte above 127 belongs to a letter; the rest parts terms.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

INDEX_SCHEMA = (
    "block BIGINT, n_docs BIGINT, n_terms BIGINT, docs ARRAY<BIGINT>, lengths BINARY, words BINARY, "
    "found_in BINARY, places BINARY, tf BINARY"
)
FOUND_SCHEMA = "item_id BIGINT, doc_id BIGINT, score BIGINT, part INT"


def terms(body: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    body = body.translate(TERM_BYTES)
    at = 0
    while at < len(body):
        end = body.find(b" ", at + PIECE)
        end = len(body) if end < 0 else end
        yield body[at:end].split()
        at = end


def build_index(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of all documents that have a term and return the written table, one row per block."""
    return stage(id_and_bytes(documents, id_col, text_col).mapInArrow(_blocks, INDEX_SCHEMA), path)


def rank_items(
    items: DataFrame,
    documents: DataFrame,
    k: int = TOP,
    item_col: str = "item_id",
    item_text_col: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The `k` best documents for each item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters above 127, with only A to Z lower-cased. Scores are integers
    and above 0; equal ones go to the smaller document id, a null id last. A null or empty text has no terms: an item without any has
    no rows, and such a document counts nowhere. Rows of `items` with one id, null included, are one item that has the
    terms of all. Each row of `documents` is a document of its own, also where ids repeat. Other columns are not
    read. Without items or documents there are no rows.
    """
    work = scratch_dir(documents.sparkSession)
    index = build_index(documents, f"{work}/index", id_col, text_col)
    return search(items, index, work, k, item_col, item_text_col)


def search(
    items: DataFrame, index: DataFrame, work: str, k: int = TOP, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """`rank_items` on an index that is there already; `work` is a folder for intermediate tables."""
    spark = items.sparkSession
    read = items.select(
        F.col(item_col).cast("bigint").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    )
    counted = read.mapInArrow(_item_terms, "item_id BIGINT, term BINARY, n BIGINT")
    counted = stage(counted.groupBy("item_id", "term").agg(F.sum("n").alias("n")), f"{work}/terms")
    documents, tokens = index.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_docs", "n_terms")]).first()

    vocabulary = counted.select("term").distinct()
    blocks = _in_blocks(vocabulary, vocabulary.count(), F.xxhash64("term"), F.collect_list("term").alias("terms"))
    df = index.select("block", "words", "found_in").crossJoin(blocks).mapInArrow(_frequencies, "term BINARY, df BIGINT")
    # A term's weight: floor(1000 ln((2N + 2) / (2df + 1))).
    odds = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weights = df.groupBy("term").agg(F.sum("df").alias("df")).select("term", F.floor(1000 * F.ln(odds)).alias("w"))
    weighed = counted.join(weights, "term").where("w > 0")
    weighed = stage(
        weighed.groupBy("item_id").agg(F.collect_list("term").alias("terms"), F.collect_list(F.col("w") * F.col("n")).alias("weights")),
        f"{work}/items",
    )
    size = weighed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    asked = _in_blocks(
        weighed, size, F.xxhash64("item_id"), F.collect_list(F.struct("item_id", "terms", "weights")).alias("items")
    )
    found = index.crossJoin(asked).mapInArrow(_search(k, documents, tokens), FOUND_SCHEMA)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    for group in (["item_id", "part"], ["item_id"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def _in_blocks(rows: DataFrame, size: int, by, *collected) -> DataFrame:
    """Rows collected into as many blocks as their terms need, in `terms_block`."""
    blocks = max(1, -(-size // QUERY_TERMS))
    return rows.groupBy(F.pmod(by, F.lit(blocks)).alias("terms_block")).agg(*collected)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, body in zip(batch.column("item_id").to_pylist(), batch.column("body")):
            for some in terms(body.as_py()):
                words, n = np.unique(np.array(some, dtype=object), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(words), pa.int64()), pa.array(words, pa.binary()), pa.array(n.astype(np.int64))],
                    names=["item_id", "term", "n"],
                )


class _Places(dict):
    """Numbers terms in the order in which they come."""

    def __missing__(self, term: bytes) -> int:
        place = self[term] = len(self)
        return place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    index, docs, tokens, size = _Places(), [], [], 0

    def block() -> pa.RecordBatch:
        every = np.concatenate(tokens)
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        # Postings by term and then by document; how often a pair comes is its frequency.
        pairs = every * np.int64(len(docs)) + np.repeat(np.arange(len(docs)), lengths)
        pairs, tf = np.unique(pairs, return_counts=True)
        found_in = np.bincount(pairs // len(docs), minlength=len(index))
        packed = [squeeze(lengths), b" ".join(index), squeeze(found_in), squeeze((pairs % len(docs)).astype(np.int32)), squeeze(tf)]
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array([n], pa.int64()) for n in (number, len(docs), len(every))),
                pa.array([docs], pa.list_(pa.int64())),
                *(pa.array([p], pa.binary()) for p in packed),
            ],
            names=["block", "n_docs", "n_terms", "docs", "lengths", "words", "found_in", "places", "tf"],
        )

    for batch in batches:
        for doc, body in zip(batch.column("doc_id").cast(pa.int64()).to_pylist(), batch.column("body")):
            ids = [np.fromiter(map(index.__getitem__, some), dtype=np.int32, count=len(some)) for some in terms(body.as_py())]
            ids = np.concatenate(ids) if ids else np.empty(0, np.int32)
            if not len(ids):
                continue
            docs.append(doc)
            tokens.append(ids)
            size += len(ids)
            if size >= BLOCK_TOKENS or len(docs) >= BLOCK_DOCS:
                yield block()
                number += 1
                index, docs, tokens, size = _Places(), [], [], 0
    if docs:
        yield block()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term of the items, in the blocks of a task."""
    counts: dict[bytes, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            place = {w: i for i, w in enumerate(row["words"].split(b" "))}
            found_in = unsqueeze(row["found_in"], np.int64)
            for term in row["terms"]:
                if (at := place.get(term)) is not None:
                    counts[term] = counts.get(term, 0) + int(found_in[at])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["term", "df"]
    )


class _Block:
    """A block of the index, with what is worked out for a term kept for the next item."""

    def __init__(self, row: dict, documents: int, tokens: int):
        self.number = row["block"]
        self.docs = row["docs"]
        self.place = {w: i for i, w in enumerate(row["words"].split(b" "))}
        self.ends = np.cumsum(unsqueeze(row["found_in"], np.int64))
        self.places = unsqueeze(row["places"], np.int32)
        self.tf = unsqueeze(row["tf"], np.int64)
        lengths = unsqueeze(row["lengths"], np.int64)
        if SLOPE * int(lengths.max()) * documents < 1 << 63:
            self.m = FLAT + SLOPE * lengths * documents // tokens
        else:
            self.m = np.array([FLAT + SLOPE * int(n) * documents // tokens for n in lengths])
        self.known: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: bytes) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Documents with the term, the factor of its weight in each, and the greatest of these."""
        at = self.place.get(term)
        if at is None:
            return None
        if at not in self.known:
            own = slice(self.ends[at - 1] if at else 0, self.ends[at])
            places, tf = self.places[own], self.tf[own]
            factor = SCALE * tf // (TF * tf + LENGTH * self.m[places])
            self.known[at] = places, factor, int(factor.max())
        return self.known[at]


def group_by_mask(postings: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents from `low` to `high` that match a term, ordered by mask; where each group starts; its mask, a row of 0 and 1."""
    # One bitmap per term, then turned: a document's column of bits is its mask.
    bitmaps = np.zeros((len(postings), high - low), dtype=bool)
    for bitmap, places in zip(bitmaps, postings):
        bitmap[places[np.searchsorted(places, low) : np.searchsorted(places, high)] - low] = True
    matched = np.flatnonzero(np.bitwise_or.reduce(bitmaps))
    masks = np.packbits(bitmaps[:, matched], axis=0).T
    wide = np.zeros((len(matched), -(-masks.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : masks.shape[1]] = masks
    words = wide.view(np.uint64)
    order = np.lexsort(words.T) if words.shape[1] > 1 else np.argsort(words[:, 0], kind="stable")
    words = words[order]
    starts = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]).any(axis=1)][: len(words)])
    return matched[order] + low, starts, np.unpackbits(masks[order[starts]], axis=1, count=len(postings))


def rank_block(block: _Block, item: tuple[list[bytes], list[int]], k: int, best: list) -> None:
    """Bring `best`, a heap of (score, null id or not, minus id), up to date with the documents of a block."""
    found = [(p, w) for p, w in zip(map(block.postings, item[0]), item[1]) if p is not None]
    if not found:
        return
    postings = [p[0] for p, _ in found]
    most = np.array([w * p[2] for p, w in found])
    if len(best) == k and most.sum() < best[0][0]:
        return
    step = max(8, CELLS // len(found))
    for low in range(0, len(block.docs), step):
        docs, starts, masks = group_by_mask(postings, low, min(low + step, len(block.docs)))
        bounds = masks.astype(np.int64) @ most
        ends = np.r_[starts[1:], len(docs)]
        order = np.argsort(-bounds, kind="stable")
        at, width = 0, FIRST_MASKS
        # Equal scores may still win by their id, so only a smaller bound ends the search.
        while at < len(order) and not (len(best) == k and bounds[order[at]] < best[0][0]):
            some = order[at : at + width]
            sizes = ends[some] - starts[some]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rows = docs[np.repeat(starts[some], sizes) + inside]
            has = np.repeat(masks[some], sizes, axis=0) == 1
            scores = np.zeros(len(rows), dtype=np.int64)
            for j, ((places, factor, _), w) in enumerate(found):
                mine = np.flatnonzero(has[:, j])
                scores[mine] += w * factor[np.searchsorted(places, rows[mine])]
            _enter(best, k, scores, rows, block.docs)
            at += width
            width *= 2


def _enter(best: list, k: int, scores: np.ndarray, rows: np.ndarray, ids: list) -> None:
    least = best[0][0] if len(best) == k else 1
    for i in np.flatnonzero(scores >= least):
        doc = ids[rows[i]]
        entry = (int(scores[i]), doc is not None, 0 if doc is None else -doc)
        if len(best) < k:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)


def _search(k: int, documents: int, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, list] = {}
        items: dict[int, list] = {}
        block = None
        for batch in batches:
            numbers = batch.column("block").to_pylist()
            wanted = batch.column("terms_block").to_pylist()
            for i, (number, some) in enumerate(zip(numbers, wanted)):
                if block is None or block.number != number:
                    block = _Block(batch.slice(i, 1).select(INDEX_COLUMNS).to_pylist()[0], documents, tokens)
                if some not in items:
                    items[some] = [(q["item_id"], (q["terms"], q["weights"])) for q in batch.column("items")[i].as_py()]
                for item, query in items[some]:
                    rank_block(block, query, k, best.setdefault(item, []))
        rows = [(item, -i if known else None, score) for item, held in best.items() for score, known, i in held]
        part = TaskContext.get().partitionId() // MERGE
        columns = [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([part] * len(rows), pa.int32())], names=["item_id", "doc_id", "score", "part"]
        )

    return run


INDEX_COLUMNS = ["block", "docs", "lengths", "words", "found_in", "places", "tf"]
