"""Vector bin packing of token sequences by the dot-product heuristic.

Pieces are placed under three limits at once: tokens, segments, and tokens that bear loss. The open
sequence takes the piece with the largest dot product of its size and the room left, each as a share
of the limit, so pieces go where they use up what is plentiful. What is left at the end of a sequence
is filled by cutting one more piece. A sequence that cannot be filled is cut back to a power of two,
a length that needs no padding, and the rest returns to the pool.

Every task packs the rows of its own partition, through a pool of bounded size, so there is no
shuffle, and no key or source can be too large for a task.
"""

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import id_and_bytes

Tokenise = Callable[[list[bytes]], list[np.ndarray]]

PIECE_SCHEMA = (
    "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, "
    "sequence_id BIGINT, offset BIGINT, segment INT, loss_tokens BIGINT"
)
# Pieces in the pool when packing begins, and when it waits for more.
POOL_FULL = 4096
POOL_LOW = 2048
PIECES_PER_BATCH = 20_000
# Rows tokenised at a time, in bytes of text.
TOKENISE_BYTES = 4_000_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


@dataclass(slots=True)
class Piece:
    """Tokens `start` to `end` of a document; `loss[i]` counts loss-bearing tokens before token i."""

    doc: int | None
    ids: np.ndarray
    loss: np.ndarray
    start: int
    end: int

    @property
    def tokens(self) -> int:
        return self.end - self.start

    @property
    def loss_tokens(self) -> int:
        return int(self.loss[self.end] - self.loss[self.start])

    def cut(self, tokens: int, loss_tokens: int) -> tuple["Piece", "Piece | None"]:
        """The longest head within both limits, and the rest. The head may be empty."""
        most = int(np.searchsorted(self.loss, self.loss[self.start] + loss_tokens, side="right")) - 1
        at = min(self.start + tokens, most, self.end)
        head = Piece(self.doc, self.ids, self.loss, self.start, at)
        return head, Piece(self.doc, self.ids, self.loss, at, self.end) if at < self.end else None


class Packer:
    """Packs a stream of documents; yields sequences as lists of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.pool: list[Piece] = []

    def add(self, doc: int | None, ids: np.ndarray, bears_loss: np.ndarray) -> Iterator[list[Piece]]:
        loss = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum(bears_loss, out=loss[1:])
        rest: Piece | None = Piece(doc, ids, loss, 0, len(ids))
        # What fills a sequence by itself needs no search.
        while rest is not None and rest.tokens >= self.limits.tokens:
            head, rest = rest.cut(self.limits.tokens, self.limits.loss_tokens)
            if head.tokens == self.limits.tokens:
                yield [head]
            else:
                self.pool.append(head)
        if rest is not None:
            head, rest = rest.cut(rest.tokens, self.limits.loss_tokens)
            while rest is not None:
                self.pool.append(head)
                head, rest = rest.cut(rest.tokens, self.limits.loss_tokens)
            self.pool.append(head)
        if len(self.pool) >= POOL_FULL:
            yield from self.drain(POOL_LOW)

    def drain(self, down_to: int = 0) -> Iterator[list[Piece]]:
        """Pack until at most `down_to` pieces are in the pool."""
        while len(self.pool) > down_to:
            pool = self.pool
            tokens = np.array([p.tokens for p in pool])
            loss = np.array([p.loss_tokens for p in pool])
            live = np.ones(len(pool), dtype=bool)
            returned: list[Piece] = []
            left = len(pool)
            # The arrays are rebuilt once half of the pool is gone.
            while left > max(len(pool) // 2, down_to - len(returned), 0):
                taken, sequence, back = self._fill(pool, tokens, loss, live)
                live[taken] = False
                left -= len(taken)
                returned += back
                yield sequence
            self.pool = [pool[i] for i in np.flatnonzero(live)] + returned

    def _fill(
        self, pool: list[Piece], tokens: np.ndarray, loss: np.ndarray, live: np.ndarray
    ) -> tuple[list[int], list[Piece], list[Piece]]:
        """One sequence: the pieces of the pool that it used up, itself, and pieces to return."""
        most = self.limits
        room_t, room_s, room_l = most.tokens, most.segments, most.loss_tokens
        taken: list[int] = []
        sequence: list[Piece] = []
        back: list[Piece] = []
        live = live.copy()
        while room_t and room_s:
            fits = live & (tokens <= room_t) & (loss <= room_l)
            # The segment's own share is the same for every piece, so it does not decide.
            score = tokens * (room_t / most.tokens**2) + loss * (room_l / most.loss_tokens**2)
            score[~fits] = -1
            best = int(score.argmax())
            if score[best] >= 0 and (room_s > 1 or tokens[best] == room_t):
                sequence.append(pool[best])
                live[best] = False
                taken.append(best)
                room_t, room_s, room_l = room_t - tokens[best], room_s - 1, room_l - loss[best]
                continue
            # Nothing whole fits, or this is the last segment: cut the longest piece to the room.
            long = np.where(live, tokens, 0)
            best = int(long.argmax())
            if long[best] == 0:
                break
            head, rest = pool[best].cut(int(room_t), int(room_l))
            if head.tokens:
                sequence.append(head)
                live[best] = False
                taken.append(best)
                if rest is not None:
                    back.append(rest)
            break
        filled = sum(p.tokens for p in sequence)
        if filled < most.tokens:
            extra = filled - (1 << (filled.bit_length() - 1))
            while extra:
                last = sequence.pop()
                head, rest = last.cut(max(last.tokens - extra, 0), most.loss_tokens)
                extra -= last.tokens - head.tokens
                if head.tokens:
                    sequence.append(head)
                back.append(rest)
        return taken, sequence, back


def pack(
    documents: Iterable[tuple[int | None, np.ndarray, np.ndarray]], limits: Limits
) -> Iterator[list[Piece]]:
    """Sequences of pieces for (id, token ids, loss flags) documents; each token is in one piece."""
    packer = Packer(limits)
    for doc, ids, bears_loss in documents:
        if len(ids):
            yield from packer.add(doc, ids, bears_loss)
    yield from packer.drain()


def pack_texts(
    documents: DataFrame,
    tokenise: Callable[[], Tokenise],
    end_id: int,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, segment, loss_tokens.

    `tokenise` makes, in each Python worker, the function from texts to ids; `end_id` is added to each
    document. Every token but a document's first bears loss, as nothing comes before that one. A
    null or empty text has the end id only. A document of any length is cut into pieces. Rows with
    equal or null ids are documents of their own. Other columns are not read. An empty table gives no
    rows.

    Sequence ids are made of the partition and a count, so the input should be a stored table: a
    task that runs again then packs the same rows.
    """
    texts = id_and_bytes(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenise()

        def rows() -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
            for docs, bodies in _groups(batches):
                for doc, ids in zip(docs, encode(bodies)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    bears_loss = np.ones(len(ids), dtype=np.int32)
                    bears_loss[0] = 0
                    yield doc, ids, bears_loss

        yield from _piece_batches(pack(rows(), limits))

    return texts.mapInArrow(run, PIECE_SCHEMA)


def pack_tokens(
    examples: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    ids_col: str = "ids",
    loss_col: str | None = None,
) -> DataFrame:
    """Like `pack_texts` for examples that are lists of token ids, with a list of loss flags each.

    Without `loss_col` every token bears loss. A missing or null flag bears none; a null or empty
    list of ids gives no piece.
    """
    flags = F.col(loss_col).cast("array<int>") if loss_col else F.transform(ids_col, lambda _: F.lit(1))
    rows = examples.select(
        F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"), flags.alias("loss")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed() -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
            for batch in batches:
                for doc, ids, loss in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "loss"))):
                    ids = np.array(ids or [], dtype="<u4")
                    bears_loss = np.zeros(len(ids), dtype=np.int32)
                    given = [x or 0 for x in loss or []][: len(ids)]
                    bears_loss[: len(given)] = given
                    yield doc, ids, bears_loss

        yield from _piece_batches(pack(listed(), limits))

    return rows.mapInArrow(run, PIECE_SCHEMA)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    docs: list = []
    bodies: list[bytes] = []
    size = 0
    for batch in batches:
        for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
            body = body.as_py()
            docs.append(doc)
            bodies.append(body)
            size += len(body)
            if size > TOKENISE_BYTES:
                yield docs, bodies
                docs, bodies, size = [], [], 0
    if docs:
        yield docs, bodies


def _piece_batches(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
    names = [column.split()[0] for column in PIECE_SCHEMA.split(", ")]
    types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
    number = TaskContext.get().partitionId() << 33
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for sequence in sequences:
        offset = 0
        for segment, p in enumerate(sequence):
            checksum = crc32(p.ids[p.start : p.end].tobytes())
            rows.append(
                (p.doc, p.start, p.tokens, checksum, len(p.ids), number, offset, segment, p.loss_tokens)
            )
            offset += p.tokens
        number += 1
        if len(rows) >= PIECES_PER_BATCH:
            yield batch()
            rows = []
    if rows:
        yield batch()
