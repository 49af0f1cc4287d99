"""Encoding and decoding with a merge-type piece vocabulary, by an agenda of adjacent symbol pairs.

A text starts as its code points. The agenda holds every pair of neighbours whose join is a piece;
the pair with the best score, the leftmost among equals, is joined first, and its new neighbours come
onto the agenda. No piece has a word mark inside, so texts fall into units that cannot influence one
another, and a unit is encoded once however often it occurs. Units that are new in a batch are
encoded side by side: one round joins the best pair of every unit.

Each batch is checked against the `sentencepiece` library, text by text, in both directions.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from playlake.llm.tables import id_and_bytes

MARK = "▁"
# Units of up to this many code points are encoded side by side; the agenda of a longer one is a heap.
SIDE_BY_SIDE = 32
UNITS_PER_ROUND = 4096
# Encoded units that a worker remembers, twice: those met lately, and as many met before them.
REMEMBERED = 1_000_000
BATCH_BYTES = 4_000_000

ENCODED_SCHEMA = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"


class PairTable:
    """Piece and score of each pair of pieces that joins to one, looked up for whole arrays.

    A pair is in one of two places, found by two hashes of it, and looking at both decides.
    """

    SLOTS = 1 << 17

    def __init__(self, joins: dict[int, int], scores: dict[int, float]):
        self.key = np.full((2, self.SLOTS), -1, dtype=np.int64)
        for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
            self.factors = (np.uint64(factor), np.uint64(factor ^ 0x5851F42D4C957F2C))
            if self._place(list(joins)):
                break
        else:
            raise ValueError("too many pairs for the table")
        self.piece = np.zeros((2, self.SLOTS), dtype=np.int32)
        self.score = np.full((2, self.SLOTS), -np.inf, dtype=np.float32)
        for side, slot in zip(*np.nonzero(self.key >= 0)):
            piece = joins[int(self.key[side, slot])]
            self.piece[side, slot] = piece
            self.score[side, slot] = scores[piece]

    def _slots(self, key: np.ndarray, side: int) -> np.ndarray:
        return (key.astype(np.uint64) * self.factors[side]) >> np.uint64(47)

    def _place(self, keys: list[int]) -> bool:
        """Put every key in one of its places, moving others to their second one as needed."""
        at = [self._slots(np.array(keys), side).tolist() for side in (0, 1)]
        held: list[list[int]] = [[-1] * self.SLOTS, [-1] * self.SLOTS]
        for index in range(len(keys)):
            side = 0
            for _ in range(1000):
                slot = at[side][index]
                index, held[side][slot] = held[side][slot], index
                if index < 0:
                    break
                side = 1 - side
            else:
                return False
        for side in (0, 1):
            placed = np.array(held[side])
            self.key[side] = np.where(placed >= 0, np.array(keys)[placed], -1)
        return True

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joined piece and score of each pair; score -inf where there is none."""
        key = (left.astype(np.int64) << 32) | right
        key[(left < 0) | (right < 0)] = -2
        first, second = self._slots(key, 0), self._slots(key, 1)
        is_first, is_second = self.key[0][first] == key, self.key[1][second] == key
        piece = np.where(is_first, self.piece[0][first], self.piece[1][second])
        score = np.where(is_first, self.score[0][first], self.score[1][second])
        score[~(is_first | is_second)] = -np.inf
        return piece, score


class PieceCodec:
    def __init__(self, library: sentencepiece.SentencePieceProcessor):
        size = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        self.library = library
        self.ids = {pieces[i]: i for i in plain}
        self.bytes = {int(pieces[i][3:-1], 16): i for i in range(size) if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.scores = {i: library.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.ids) or any("\n" in p for p in self.ids):
            raise ValueError("pieces with a word mark or line feed inside are not supported")
        # What each id shows; None for bytes that are a character only with others.
        self.shown: list[bytes | None] = [b""] * size
        for i in plain:
            self.shown[i] = pieces[i].replace(MARK, " ").encode()
        for i, b in self.byte_of.items():
            self.shown[i] = bytes([b]) if b < 0x80 else None
        for i in range(size):
            if library.is_unknown(i):
                self.shown[i] = " ⁇ ".encode()
        self._end = np.array([library.eos_id()], dtype=np.int32).tobytes()
        self.decimal = [str(i) for i in range(size)]
        self._units = re.compile(" *[^ \n]+| +|\n")
        # Every way to join two pieces into one.
        self._pairs = {
            self.ids[p[:at]] << 32 | self.ids[p[at:]]: i
            for p, i in self.ids.items()
            for at in range(1, len(p))
            if p[:at] in self.ids and p[at:] in self.ids
        }
        self._table = PairTable(self._pairs, self.scores)
        # Piece of each code point; those without one are -1 - code point, which joins nothing.
        self._of_point = -1 - np.arange(0x110000, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self._of_point[ord(p)] = i
        self._of_point[ord(" ")] = self.ids[MARK]
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, and the end id."""
        # A blank and a word mark are the same; with blanks, most texts need one byte per character.
        split = [self._units.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(self._known) > REMEMBERED:
            self._known, self._older = {}, self._known
        new = set(chain.from_iterable(split)) - self._known.keys()
        if self._older:
            met = new & self._older.keys()
            self._known.update(zip(met, map(self._older.__getitem__, met)))
            new -= met
        self._learn(new)
        known = self._known.__getitem__
        return [np.frombuffer(b"".join(map(known, units)) + self._end, dtype=np.int32).tolist() for units in split]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: bytes that are no UTF-8 become replacement characters.

        The blank that starts the first piece is the one that encoding put there, and goes.
        """
        try:
            text = b"".join(map(self.shown.__getitem__, ids)).decode()
        except TypeError:  # bytes that have to be put together
            out, run = [], b""
            for i in ids:
                if self.shown[i] is None:
                    run += bytes([self.byte_of[i]])
                    continue
                out += [_utf8(run), self.shown[i]]
                run = b""
            text = b"".join([*out, _utf8(run)]).decode()
        first = next((i for i in ids if not self.library.is_control(i)), None)
        added = first is not None and first not in self.byte_of and text.startswith(" ")
        return text[1:] if added and not self.library.is_unknown(first) else text

    def _learn(self, units: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        for length, same in by_length.items():
            if length > SIDE_BY_SIDE:
                for unit in same:
                    self._known[unit] = np.array(self._spell(self._heap(unit)), dtype=np.int32).tobytes()
                continue
            for at in range(0, len(same), UNITS_PER_ROUND):
                some = same[at : at + UNITS_PER_ROUND]
                self._known.update(zip(some, self._side_by_side(some, length)))

    def _start(self, units: list[str]) -> np.ndarray:
        return self._of_point[np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4")]

    def _spell(self, symbols: list[int]) -> list[int]:
        """Code points without a piece become the pieces of their bytes."""
        out: list[int] = []
        for s in symbols:
            out += [s] if s >= 0 else [self.bytes[b] for b in chr(-1 - s).encode()]
        return out

    def _side_by_side(self, units: list[str], length: int) -> list[bytes]:
        """Encode units of one length. Column `length` stands for the end of every unit."""
        n = len(units)
        symbol = np.full((n, length + 1), -1, dtype=np.int32)
        symbol[:, :length] = self._start(units).reshape(n, length)
        alive = np.ones((n, length + 1), dtype=bool)
        alive[:, length] = False
        place = np.arange(length + 1, dtype=np.int32)
        # The next and the previous symbol that is left.
        after = np.broadcast_to(np.minimum(place + 1, length), (n, length + 1)).copy()
        before = np.broadcast_to(place - 1, (n, length + 1)).copy()
        joined = np.zeros((n, length + 1), dtype=np.int32)
        score = np.full((n, length + 1), -np.inf, dtype=np.float32)
        joined[:, :-1], score[:, :-1] = self._table.find(symbol[:, :-1], symbol[:, 1:])
        rows = np.flatnonzero((score > -np.inf).any(axis=1))
        while len(rows):
            best = score[rows].argmax(axis=1)
            live = score[rows, best] > -np.inf
            rows, best = rows[live], best[live]
            gone = after[rows, best]
            follow = after[rows, gone]
            symbol[rows, best] = joined[rows, best]
            alive[rows, gone] = False
            score[rows, gone] = -np.inf
            after[rows, best] = follow
            before[rows, follow] = best
            joined[rows, best], score[rows, best] = self._table.find(symbol[rows, best], symbol[rows, follow])
            left = before[rows, best]
            own = left >= 0
            r, at = rows[own], left[own]
            joined[r, at], score[r, at] = self._table.find(symbol[r, at], symbol[r, best[own]])
        kept = symbol[alive].tobytes()
        ends = (alive.sum(axis=1).cumsum() * 4).tolist()
        out = [kept[start:end] for start, end in zip([0, *ends], ends)]
        for i in np.flatnonzero(((symbol < 0) & alive).any(axis=1)):
            out[i] = np.array(self._spell(np.frombuffer(out[i], dtype=np.int32).tolist()), dtype=np.int32).tobytes()
        return out

    def _heap(self, unit: str) -> list[int]:
        from heapq import heapify, heappop, heappush

        symbol: list[int | None] = self._start([unit]).tolist()
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def entry(a: int, b: int) -> tuple[float, int, int, int, int] | None:
            if symbol[a] is None or symbol[a] < 0 or symbol[b] < 0:
                return None
            piece = self._pairs.get(symbol[a] << 32 | symbol[b])
            return None if piece is None else (-self.scores[piece], a, piece, symbol[a], symbol[b])

        agenda = [e for a in range(n - 1) if (e := entry(a, a + 1))]
        heapify(agenda)
        while agenda:
            _, a, piece, left, right = heappop(agenda)
            b = after[a]
            # One of the two has been joined to something else since.
            if symbol[a] != left or b >= n or symbol[b] != right:
                continue
            symbol[a], symbol[b] = piece, None
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                if e := entry(a, after[a]):
                    heappush(agenda, e)
            if before[a] >= 0 and (e := entry(before[a], a)):
                heappush(agenda, e)
        return [s for s in symbol if s is not None]


def _utf8(run: bytes) -> bytes:
    """Each byte that does not belong to a valid character becomes one replacement character."""
    out = b""
    while run:
        try:
            return out + run.decode().encode()
        except UnicodeDecodeError as error:
            out += run[: error.start] + "�".encode()
            run = run[error.start + 1 :]
    return out


@cache
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(sentencepiece.SentencePieceProcessor(model_file=model_file))


def encode_documents(
    documents: DataFrame,
    model_file: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids are those of the text and the end id. The digest of the ids is over their decimal form, joined
    by single blanks; the other one is over the text decoded from the ids. A null text is empty and
    has the end id only. A result that differs from the library's stops the job. Other columns are
    not read. An empty table gives no rows. The model file must be at the same path on every machine.
    """
    texts = id_and_bytes(documents, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file or public_tokenizers.path("piece_bpe_32k.model"))
        for docs, bodies in _groups(batches):
            ids, decoded = checked(own, bodies)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([_digest(" ".join(map(own.decimal.__getitem__, i))) for i in ids], pa.string()),
                    pa.array([_digest(t) for t in decoded], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts.mapInArrow(run, ENCODED_SCHEMA)


def checked(own: PieceCodec, texts: list[str]) -> tuple[list[list[int]], list[str]]:
    """Ids with the end id, and the texts decoded from them; equal to the library's."""
    if not texts:
        return [], []
    ids = own.encode(texts)
    if ids != own.library.encode(texts, add_eos=True, num_threads=1):
        raise ValueError("encoding differs from the library's")
    decoded = [own.decode(i) for i in ids]
    if decoded != own.library.decode(ids, num_threads=1):
        raise ValueError("decoding differs from the library's")
    return ids, decoded


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    docs: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
            text = body.as_py().decode()
            docs.append(doc)
            texts.append(text)
            size += len(text)
            if size > BATCH_BYTES:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts
