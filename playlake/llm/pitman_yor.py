"""A hierarchical Pitman-Yor language model, trained by Gibbs sampling and used to score documents.

There is one restaurant for each word that others follow, one for the start of a text, and one that is the
parent of them all, over a uniform distribution of the known words and one unknown. The context of a word is
the word before it. Customers are the training tokens; every table of a context sends a customer to the parent.

A sweep draws the tables of every pair of context and word, and of every word in the parent, given all
else as the last sweep left it. The number of tables is drawn at once from its distribution given the customers: the ways to seat
them at so many tables, a generalised Stirling number, times the chance of so many new tables. So a sweep is one pass over the
pairs that occur more than once and one over the words, in parallel. A pair that occurs
once has one table always. Predictive probabilities are averaged over several sweeps.

Words are numbered once, and documents go through in blocks. A block counts its distinct pairs and sends them, as arrays of
numbers, to buckets of pairs, which a hash of both words chooses: so no bucket gets all pairs of a frequent word. Words have buckets of
their own. From then on blocks and buckets send each other arrays only, one row per sender, receiver and kind,
and a pair is shuffled once; the number of buckets grows with the tokens.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import id_and_bytes, stage
from playlake.scratch import discard, scratch_dir

BURN_IN = 2
SAMPLES = 3
STRENGTH = 1.0
# Numbers of ways to seat customers are tabled up to so many customers: up to the first number all rows are kept, further on
# only some, from which those between follow. Beyond, rows follow from the last one by scaling. Rows asked for are kept for a while.
EVERY_ROW, EVERY, TABLED = 512, 64, 4096
ASKED_ROWS = 2000
# Weights this far below the greatest, as logarithms, are left out of a draw.
NEGLIGIBLE = 50.0
# Weights that are worked out at a time.
CELLS = 1 << 21
BLOCK_TOKENS = 6_000_000
# Distinct words of blocks, and tokens, per bucket.
BUCKET_WORDS = 2_000_000
BUCKET_TOKENS = 2_000_000
# Words are numbered within their bucket, which is the upper part of their number.
NUMBER_BITS = 32
FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
# Stands for the end of a text; no word holds a line feed.
END = b"\n"
# Stands before a text; no word is empty.
START = b""

BLOCK_SCHEMA = (
    "block BIGINT, docs ARRAY<BIGINT>, held_out BINARY, lengths BINARY, tokens BINARY, words BINARY, n_tokens BIGINT, n_words BIGINT"
)
# What a block or bucket sends to another, or keeps for itself: arrays, and a few figures for the driver to add up.
MESSAGE = "receiver BIGINT, sender BIGINT, kind STRING, parts ARRAY<BINARY>, figures ARRAY<BIGINT>"
MESSAGE_ARROW = pa.schema(
    [
        ("receiver", pa.int64()), ("sender", pa.int64()), ("kind", pa.string()),
        ("parts", pa.list_(pa.binary())), ("figures", pa.list_(pa.int64())),
    ]
)
SCORE_SCHEMA = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
    "base_score DOUBLE, score DOUBLE"
)


@dataclass
class Parent:
    """Numbers of the parent, and the discounts."""

    customers: int
    tables: int
    types: int
    discount: float
    root_discount: float

    def new_root(self) -> float:
        """The parent's probability of a word nobody in it has ordered."""
        return (STRENGTH + self.root_discount * self.tables) / (STRENGTH + self.customers) / (self.types + 1)

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        own = (customers - self.root_discount * tables) / (STRENGTH + self.customers)
        return own + self.new_root()

    def own(self, customers: np.ndarray, tables: np.ndarray, of_context: np.ndarray) -> np.ndarray:
        """Share of a context with `of_context` customers that a word has by itself."""
        return (customers - self.discount * tables) / (STRENGTH + of_context)

    def backing(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Share of contexts that goes to the parent."""
        return (STRENGTH + self.discount * tables) / (STRENGTH + customers)


def is_held_out(doc: int | None) -> bool:
    return crc32(b"" if doc is None else str(doc).encode()) % 10 == 0


class Seatings:
    """Logarithms of the ways to seat customers at tables, weighed by a discount: generalised Stirling numbers.

    With one more customer, c + 1 at t tables: those of c at t - 1, and c - discount * t times those of c at t. That
    many ways, over the factorial of t - 1 and discount^(t - 1), depend on t over c^discount alone as c grows, but for
    the factorial of c - 1; so rows beyond TABLED customers follow from the last one, up to a share of about
    c^-discount.
    """

    def __init__(self, discount: float):
        self.discount = discount
        self.kept = {1: np.zeros(1)}
        row = self.kept[1]
        for c in range(2, TABLED + 1):
            row = self._next(row)
            if c <= EVERY_ROW or c % EVERY == 0:
                self.kept[c] = row
        self.asked: dict[int, np.ndarray] = {}

    def _next(self, row: np.ndarray) -> np.ndarray:
        c = len(row)
        t = np.arange(1, c + 1)
        return np.logaddexp(np.r_[-np.inf, row], np.r_[row + np.log(c - self.discount * t), -np.inf])

    def row(self, c: int) -> np.ndarray:
        """For t = 1 to c tables, if c is tabled; else up to the tables that the last row tells of."""
        known = self.kept.get(c, self.asked.get(c))
        if known is not None:
            return known
        if c > TABLED:
            row = self._scaled(c)
        else:
            row = self.kept[max(EVERY_ROW, c // EVERY * EVERY)]
            while len(row) < c:
                row = self._next(row)
        if len(self.asked) >= ASKED_ROWS:
            self.asked.clear()
        self.asked[c] = row
        return row

    def _scaled(self, c: int) -> np.ndarray:
        row = self.kept[TABLED]
        t = np.arange(1, TABLED + 1)
        # What depends on t over c^discount alone.
        shape = row + _log_factorials(t) + t * math.log(self.discount) - math.lgamma(TABLED)
        most = int(TABLED * 0.9 * (c / TABLED) ** self.discount)
        t_here = np.arange(1, min(c, most) + 1)
        place, places = np.log(t_here / c**self.discount), np.log(t / TABLED**self.discount)
        # Below the first place it is in proportion to t.
        scaled = np.interp(place, places, shape) + np.minimum(place - places[0], 0)
        return scaled - _log_factorials(t_here) - t_here * math.log(self.discount) + math.lgamma(c)


def _log_factorials(t: np.ndarray) -> np.ndarray:
    """Of t = 1, 2 and so on."""
    return np.cumsum(np.log(t))


SEATINGS: dict[float, Seatings] = {}


def log_weights(c: int, others: np.ndarray, parent: np.ndarray, discount: float, most: int | None = None) -> np.ndarray:
    """Logarithms of the weights of 1, 2, ... tables for `c` customers of a word, a row for each restaurant.

    `others` are the tables of other words there and `parent` the parent's probabilities of the word.
    """
    if discount not in SEATINGS:
        SEATINGS[discount] = Seatings(discount)
    ways = SEATINGS[discount].row(c)[:most]
    t = np.arange(len(ways))
    fresh = np.cumsum(np.log(STRENGTH + discount * (others[:, None] + t)), axis=1)
    return ways + fresh + (t + 1) * np.log(parent)[:, None]


def draw_tables(
    customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, draw: np.random.Generator
) -> np.ndarray:
    """Tables that `customers` of one word have in restaurants with `others` tables, drawn given all else."""
    tables = (customers > 0).astype(np.int64)
    for c in np.unique(customers[customers > 1]).tolist():
        rows = np.flatnonzero(customers == c)
        most = min(c, 256)
        step = max(1, CELLS // c)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            while True:
                weights = log_weights(c, others[some], parent[some], discount, most)
                greatest = weights.max(axis=1)
                # The weights rise to one peak and fall; more are needed until all have fallen.
                if weights.shape[1] < most or most >= c or (weights[:, -1] < greatest - NEGLIGIBLE).all():
                    break
                most = min(c, 4 * most)
            upto = np.cumsum(np.exp(weights - greatest[:, None]), axis=1)
            tables[some] = 1 + (upto < (draw.random(len(some)) * upto[:, -1])[:, None]).sum(axis=1)
    return tables


def score_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    burn_in: int = BURN_IN,
    samples: int = SAMPLES,
) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are what stands between blanks, with A to Z lower-cased; every text has one end token more. Rows
    whose id, as decimal text, has a CRC-32 divisible by 10 are held out, all others train. A null id counts
    as empty text and is held out; a null text is empty. `score` is the log10 probability of the text and
    its end, `base_score` the one of single tokens with 0.1 added to each count. Rows with equal ids are
    documents of their own. Without training rows every word is the unknown one and its probability is 1 in
    both models. Other columns are not read. An empty table gives no rows.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    blocks = stage(id_and_bytes(documents, id_col, text_col).mapInArrow(_blocks, BLOCK_SCHEMA), f"{work}/blocks")
    tokens, words_asked = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_words")]).first()
    word_buckets, pair_buckets = -(-words_asked // BUCKET_WORDS) or 1, -(-tokens // BUCKET_TOKENS) or 1
    of_blocks = blocks.groupBy("block")

    asked = blocks.mapInArrow(_ask_words(word_buckets), MESSAGE)
    named = stage(asked.groupBy("receiver").applyInArrow(_number_words, MESSAGE), f"{work}/named")
    numbers = _of_kind(named, "numbers")
    asked = of_blocks.cogroup(numbers.groupBy("receiver")).applyInArrow(_ask_pairs(word_buckets, pair_buckets), MESSAGE)
    pairs = stage(asked.groupBy("receiver").applyInArrow(_merge_pairs, MESSAGE), f"{work}/pairs")
    ones, twos = _figures(pairs, "counted", 2)
    words = _of_kind(named, "vocabulary").groupBy("receiver").cogroup(_of_kind(pairs, "totals").groupBy("receiver"))
    words = stage(words.applyInArrow(_first_words, MESSAGE), f"{work}/words")
    types, train_tokens, once, twice = _figures(words, "words", 4)

    def seat_words(state: DataFrame, before: Parent | None, sweep: int, keep: bool, path: str) -> DataFrame:
        asked = state.mapInArrow(_ask_tables, MESSAGE)
        seated = _of_kind(words, "words").groupBy("receiver").cogroup(asked.groupBy("receiver"))
        return stage(seated.applyInArrow(_seat_words(before, sweep, keep), MESSAGE), path)

    state = _of_kind(pairs, "state")
    words = seat_words(state, None, 0, False, f"{work}/seated")
    parent = Parent(*_figures(words, "words", 2), types, _discount(ones, twos), _discount(once, twice))
    sampled: list[Parent] = []
    for sweep in range(burn_in + samples):
        keep, now = sweep >= burn_in, f"{work}/sweep{sweep}"
        seated = state.groupBy("receiver").cogroup(_of_kind(words, "tables").groupBy("receiver"))
        state = stage(seated.applyInArrow(_seat_pairs(parent, sweep, keep), MESSAGE), f"{now}-pairs")
        words = seat_words(state, parent, sweep, keep, f"{now}-words")
        parent = Parent(*_figures(words, "words", 2), types, parent.discount, parent.root_discount)
        if keep:
            sampled.append(parent)
        for used in [f"{work}/sweep{sweep - 1}-{kind}" for kind in ("pairs", "words")] if sweep else [f"{work}/words", f"{work}/seated"]:
            discard(spark, used)

    told = _of_kind(pairs, "counted").groupBy("receiver").cogroup(state.groupBy("receiver"))
    told = told.applyInArrow(_tell_pairs(samples), MESSAGE)
    named_here = _of_kind(words, "words").groupBy("receiver").cogroup(numbers.groupBy("sender"))
    told = told.unionByName(named_here.applyInArrow(_tell_words, MESSAGE))
    return of_blocks.cogroup(told.groupBy("receiver")).applyInArrow(
        _score(sampled, train_tokens, word_buckets, pair_buckets), SCORE_SCHEMA
    )


def _of_kind(messages: DataFrame, kind: str) -> DataFrame:
    return messages.where(F.col("kind") == kind)


def _figures(messages: DataFrame, kind: str, n: int) -> list[int]:
    """The first figures of the messages of a kind, each added up."""
    sums = [F.coalesce(F.sum(F.get("figures", F.lit(i))), F.lit(0)) for i in range(n)]
    return list(_of_kind(messages, kind).agg(*sums).first())


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers with their bytes dealt by place, which makes small ones short, compressed."""
    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def words_of(row: dict) -> list[bytes]:
    # The end is a line feed itself and no word holds a blank.
    return zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")


class _Index(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    index, docs, tokens = _Index(), [], []
    size = 0

    def block() -> pa.RecordBatch:
        held_out = np.array([is_held_out(d) for d in docs], dtype=np.uint8)
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        every = np.concatenate(tokens)
        words = list(index)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                *(pa.array([squeeze(a)], pa.binary()) for a in (held_out, lengths, every)),
                pa.array([zstandard.ZstdCompressor(level=1).compress(b" ".join(words))], pa.binary()),
                pa.array([len(every)], pa.int64()),
                pa.array([len(words)], pa.int64()),
            ],
            names=["block", "docs", "held_out", "lengths", "tokens", "words", "n_tokens", "n_words"],
        )

    for batch in batches:
        for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
            words = body.as_py().lower().split()
            words.append(END)
            docs.append(doc)
            tokens.append(np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words)))
            size += len(words)
            if size >= BLOCK_TOKENS:
                yield block()
                number += 1
                index, docs, tokens, size = _Index(), [], [], 0
    if docs:
        yield block()


class Block:
    """A block. The last of `words` is START."""

    def __init__(self, row: dict):
        self.words = [*words_of(row), START]
        self.tokens = unsqueeze(row["tokens"], np.int32)
        self.lengths = unsqueeze(row["lengths"], np.int64)
        self.held_out = unsqueeze(row["held_out"], np.uint8) == 1
        self.trained = np.repeat(~self.held_out, self.lengths)

    def find_pairs(self) -> None:
        """Sets contexts and words of the distinct pairs, the pair of each token, and training tokens per pair."""
        before = np.roll(self.tokens, 1)
        before[np.cumsum(self.lengths) - self.lengths] = len(self.words) - 1
        pairs = before.astype(np.int64) * len(self.words) + self.tokens
        pairs, self.pair = np.unique(pairs, return_inverse=True)
        self.contexts, self.followers = pairs // len(self.words), pairs % len(self.words)
        self.counts = np.bincount(self.pair[self.trained], minlength=len(pairs))

    def hash_words(self) -> np.ndarray:
        hashes = map(xxhash.xxh3_64_intdigest, self.words)
        return np.fromiter(hashes, dtype=np.uint64, count=len(self.words))

    def word_places(self, hashes: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
        """The buckets of words that are asked, and the places in this block of the words of each."""
        return _dealt(hashes % np.uint64(buckets))

    def pair_places(self, hashes: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
        mixed = hashes[self.contexts] * FACTORS[0] + hashes[self.followers]
        mixed = (mixed ^ mixed >> np.uint64(29)) * FACTORS[1]
        return _dealt((mixed ^ mixed >> np.uint64(32)) % np.uint64(buckets))


def _dealt(buckets: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each bucket that occurs, in order, and its places."""
    order = np.argsort(buckets, kind="stable")
    found, starts = np.unique(buckets[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, starts[1:]))) if len(order) else []


def _message(receiver: int, sender: int, kind: str, parts: list[bytes], figures: tuple = ()) -> dict:
    return {"receiver": receiver, "sender": sender, "kind": kind, "parts": parts, "figures": [int(n) for n in figures]}


def _sent(messages: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(messages, schema=MESSAGE_ARROW)


def _received(messages: pa.Table, kind: str | None = None) -> list[dict]:
    """In the order of the senders, so that what is done does not depend on the order of rows."""
    rows = messages.to_pylist()
    return sorted((r for r in rows if kind in (None, r["kind"])), key=lambda r: r["sender"])


def _arrays(message: dict) -> list[np.ndarray]:
    return [unsqueeze(part, np.int64) for part in message["parts"]]


def _squeezed(*arrays: np.ndarray) -> list[bytes]:
    return [squeeze(a.astype(np.int64)) for a in arrays]


def _steps(numbers: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, which are small."""
    return np.diff(numbers, prepend=0)


def _place(numbers: np.ndarray) -> np.ndarray:
    """Of words in their bucket."""
    return numbers & ((1 << NUMBER_BITS) - 1)


def _per_word(word: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct words, and for each the sums of the values."""
    words, place = np.unique(word, return_inverse=True)
    return [words, *(np.bincount(place, weights=v, minlength=len(words)).astype(np.int64) for v in values)]


def _to_words(sender: int, kind: str, contexts: list[np.ndarray], words: list[np.ndarray]) -> list[dict]:
    """What is known of contexts and of words, sent to their buckets; the first array of each has the sorted numbers."""
    messages = []
    of_contexts, of_words = contexts[0] >> NUMBER_BITS, words[0] >> NUMBER_BITS
    for bucket in np.union1d(of_contexts, of_words).tolist():
        parts = []
        for buckets, (numbers, *values) in ((of_contexts, contexts), (of_words, words)):
            some = slice(*np.searchsorted(buckets, [bucket, bucket + 1]))
            parts += _squeezed(_steps(numbers[some]), *(v[some] for v in values))
        messages.append(_message(bucket, sender, kind, parts))
    return messages


def _ask_words(buckets: int):
    """A block's words, with its training tokens of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                counts = np.bincount(block.tokens[block.trained], minlength=len(block.words))
                messages = []
                for bucket, places in block.word_places(block.hash_words(), buckets):
                    words = b" ".join([block.words[p] for p in places.tolist()])
                    parts = [zstandard.ZstdCompressor(level=1).compress(words), *_squeezed(counts[places])]
                    messages.append(_message(bucket, row["block"], "words", parts))
                yield from _sent(messages).to_batches()

    return run


def _number_words(asked: pa.Table) -> pa.Table:
    """Numbers for each block's words, and the training tokens of each word."""
    rows = _received(asked)
    bucket = rows[0]["receiver"]
    spelled = [zstandard.ZstdDecompressor().decompress(r["parts"][0]).split(b" ") for r in rows]
    vocabulary = sorted(set().union(*spelled))
    index = dict(zip(vocabulary, range(len(vocabulary))))
    n, messages = np.zeros(len(vocabulary), dtype=np.int64), []
    for row, words in zip(rows, spelled):
        places = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
        n[places] += unsqueeze(row["parts"][1], np.int64)
        numbers = (bucket << NUMBER_BITS) + places
        messages.append(_message(row["sender"], bucket, "numbers", _squeezed(numbers)))
    messages.append(_message(bucket, bucket, "vocabulary", _squeezed(n)))
    return _sent(messages)


def _ask_pairs(word_buckets: int, pair_buckets: int):
    """A block's distinct pairs, with its training tokens of each."""

    def run(block: pa.Table, numbered: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        block = Block(row)
        block.find_pairs()
        hashes = block.hash_words()
        numbers = np.zeros(len(block.words), dtype=np.int64)
        for (_, places), message in zip(block.word_places(hashes, word_buckets), _received(numbered)):
            numbers[places] = _arrays(message)[0]
        messages = []
        for bucket, places in block.pair_places(hashes, pair_buckets):
            contexts, words = numbers[block.contexts[places]], numbers[block.followers[places]]
            messages.append(_message(bucket, row["block"], "pairs", _squeezed(contexts, words, block.counts[places])))
        return _sent(messages)

    return run


def _merge_pairs(asked: pa.Table) -> pa.Table:
    """The pairs of a bucket.

    Kept are the tokens of all, with what each block asked for; those that occur more than once, with a table each; and
    for their words, what contexts and words have in this bucket.
    """
    rows = _received(asked)
    bucket = rows[0]["receiver"]
    sent = [_arrays(r) for r in rows]
    contexts, words, counts = (np.concatenate(a) for a in zip(*sent))
    order = np.lexsort((words, contexts))
    contexts, words = contexts[order], words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    c = np.add.reduceat(counts[order], np.flatnonzero(new))
    contexts, words = contexts[new], words[new]
    blocks = np.array([r["sender"] for r in rows]), np.array([len(a[0]) for a in sent])
    again, known = c > 1, c > 0
    state = [_steps(contexts[again]), words[again], c[again], np.ones(again.sum()), np.zeros(again.sum())]
    once = c[known] == 1
    return _sent(
        [
            _message(bucket, bucket, "counted", _squeezed(*blocks, which, c), (once.sum(), (c == 2).sum())),
            _message(bucket, bucket, "state", _squeezed(*state)),
            *_to_words(bucket, "totals", _per_word(contexts[known], c[known], once), _per_word(words[known], once)),
        ]
    )


def _first_words(vocabulary: pa.Table, totals: pa.Table) -> pa.Table:
    """Words: tokens of each, tokens after it, pairs that occur once after and before it, and tables in the parent: one if it is known."""
    [message] = _received(vocabulary)
    [n] = _arrays(message)
    followed, single_after, single = (np.zeros(len(n), dtype=np.int64) for _ in range(3))
    for row in _received(totals):
        contexts, c, once, words, once_before = _arrays(row)
        at = _place(np.cumsum(contexts))
        followed[at] += c
        single_after[at] += once
        single[_place(np.cumsum(words))] += once_before
    parts = _squeezed(n, followed, single_after, single, n > 0)
    figures = (n > 0).sum(), n.sum(), (n == 1).sum(), (n == 2).sum()
    return _sent([_message(message["receiver"], message["receiver"], "words", parts, figures)])


def _ask_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tables that contexts and words have in a bucket of pairs."""
    for batch in batches:
        for row in batch.to_pylist():
            contexts, words, _, t, _ = _arrays(row)
            contexts = np.cumsum(contexts)
            messages = _to_words(row["receiver"], "tables", _per_word(contexts, t), _per_word(words, t))
            yield from _sent(messages).to_batches()


def _seat_words(parent: Parent | None, sweep: int, keep: bool):
    """Adds up the tables of contexts and of words, draws the tables of words in the parent, and tells the buckets of pairs.

    Without `parent`, nothing is drawn.
    """

    def run(words: pa.Table, asked: pa.Table) -> pa.Table:
        [message] = _received(words)
        bucket = message["receiver"]
        n, followed, single_after, single, t, *kept = _arrays(message)
        context_t, customers = single_after.copy(), single.copy()
        rows = _received(asked)
        places = []
        for row in rows:
            contexts, of_contexts, own, of_words = _arrays(row)
            contexts, own = _place(np.cumsum(contexts)), _place(np.cumsum(own))
            context_t[contexts] += of_contexts
            customers[own] += of_words
            places.append((contexts, own))
        if parent:
            draw = np.random.default_rng([sweep, bucket])
            base = np.full(len(n), 1 / (parent.types + 1))
            t = draw_tables(customers, parent.tables - t, base, parent.root_discount, draw)
        if keep:
            kept += [context_t, customers, t]
        parts = _squeezed(n, followed, single_after, single, t, *kept)
        messages = [_message(bucket, bucket, "words", parts, (customers.sum(), t.sum()))]
        for row, (contexts, own) in zip(rows, places):
            parts = _squeezed(context_t[contexts], customers[own], t[own])
            messages.append(_message(row["sender"], bucket, "tables", parts))
        return _sent(messages)

    return run


def _seat_pairs(parent: Parent, sweep: int, keep: bool):
    """Draws the tables of pairs."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        [message] = _received(state)
        bucket = message["receiver"]
        steps, words, c, t, sum_t = _arrays(message)
        # Buckets of words answer in the order of the numbers.
        answers = [_arrays(row) for row in _received(told)] or [[c, c, c]]
        of_contexts, of_words, of_tables = (np.concatenate(a) for a in zip(*answers))
        _, context = np.unique(np.cumsum(steps), return_inverse=True)
        _, word = np.unique(words, return_inverse=True)
        # The parent as the other contexts leave it.
        others = of_words[word] - t
        root = parent.root(others, np.minimum(of_tables[word], others))
        draw = np.random.default_rng([sweep, bucket, 1])
        t = draw_tables(c, of_contexts[context] - t, root, parent.discount, draw)
        parts = _squeezed(steps, words, c, t, sum_t + t if keep else sum_t)
        return _sent([_message(bucket, bucket, "state", parts)])

    return run


def _tell_pairs(samples: int):
    """For each block, tokens of its pairs and their tables, added up over the samples."""

    def run(counted: pa.Table, state: pa.Table) -> pa.Table:
        [message] = _received(counted)
        blocks, sizes, which, c = _arrays(message)
        sum_t = np.where(c == 1, samples, 0)
        sum_t[c > 1] = _arrays(_received(state)[0])[4]
        ends = np.cumsum(sizes)
        messages = []
        for block, asked in zip(blocks.tolist(), np.split(which, ends[:-1])):
            messages.append(_message(block, message["receiver"], "pairs", _squeezed(c[asked], sum_t[asked])))
        return _sent(messages)

    return run


def _tell_words(words: pa.Table, numbers: pa.Table) -> pa.Table:
    """For each block, what is known of its words."""
    [message] = _received(words)
    n, followed, _, _, _, *kept = _arrays(message)
    messages = []
    for row in numbers.to_pylist():
        at = _place(_arrays(row)[0])
        messages.append(_message(row["receiver"], message["receiver"], "words", _squeezed(n[at], followed[at], *(k[at] for k in kept))))
    return _sent(messages)


def _discount(ones: int, twos: int) -> float:
    """The discount that counts of one and two suggest, kept off the ends."""
    return min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.05), 0.95)


def predictive(
    sampled: list[Parent],
    context: np.ndarray,
    word: np.ndarray,
    c: np.ndarray,
    sum_t: np.ndarray,
    customers: np.ndarray,
    context_t: np.ndarray,
    root_c: np.ndarray,
    root_t: np.ndarray,
) -> np.ndarray:
    """Probabilities of pairs of context and word: the average over samples of each one's own part and what it has from the parent.

    `c` and `sum_t` are of the pairs, `customers` of contexts; the others are of contexts or words, a row per sample.
    """
    chance = np.zeros(len(context))
    for i, parent in enumerate(sampled):
        chance += parent.backing(customers, context_t[i])[context] * parent.root(root_c[i], root_t[i])[word]
    return chance / len(sampled) + sampled[0].own(c, sum_t / len(sampled), customers[context])


def _score(sampled: list[Parent], train_tokens: int, word_buckets: int, pair_buckets: int):
    samples = len(sampled)

    def run(row: pa.Table, told: pa.Table) -> pa.Table:
        row = row.to_pylist()[0]
        block = Block(row)
        block.find_pairs()
        hashes = block.hash_words()
        c, sum_t = (np.zeros(len(block.counts), dtype=np.int64) for _ in range(2))
        for (_, places), message in zip(block.pair_places(hashes, pair_buckets), _received(told, "pairs")):
            c[places], sum_t[places] = _arrays(message)
        known = np.zeros((2 + 3 * samples, len(block.words)), dtype=np.int64)
        for (_, places), message in zip(block.word_places(hashes, word_buckets), _received(told, "words")):
            known[:, places] = _arrays(message)
        n, customers, *of_samples = known
        return scored(block, row["docs"], sampled, train_tokens, c, sum_t, n, customers, *(of_samples[i::3] for i in range(3)))

    return run


def scored(
    block: Block,
    docs: list,
    sampled: list[Parent],
    train_tokens: int,
    c: np.ndarray,
    sum_t: np.ndarray,
    n: np.ndarray,
    customers: np.ndarray,
    context_t: list[np.ndarray],
    root_c: list[np.ndarray],
    root_t: list[np.ndarray],
) -> pa.Table:
    """The documents of a block, given what `predictive` needs of its pairs and words, and the tokens `n` of the words."""
    chance = predictive(sampled, block.contexts, block.followers, c, sum_t, customers, context_t, root_c, root_t)
    logs = np.log10(chance)[block.pair]
    tokens = block.tokens
    base = np.log10((n + 0.1) / (train_tokens + 0.1 * (sampled[0].types + 1)))[tokens]
    starts = np.cumsum(block.lengths) - block.lengths
    return pa.table(
        {
            "doc_id": pa.array(docs, pa.int64()),
            "held_out": pa.array(block.held_out),
            "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(np.add.reduceat((n > 0)[tokens].astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(starts), train_tokens, dtype=np.int64)),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(np.add.reduceat(logs, starts)),
        }
    )
