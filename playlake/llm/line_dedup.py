"""Removal of repeated passages by content-defined chunks of lines and sentences.

Units are lines, cut also after every sentence in them and before every capital. A chunk starts at every unit, and a rolling hash over
the hashes of neighbouring units chooses where it ends, so a passage that stands in two documents is cut alike
in both, whatever stands around it, also inside a line.
Chunks also end once they have more than PASSAGE_WORDS words, so a passage that long always holds a chunk.
Chunks that occur more than once are removed everywhere but at their first place. They are
grouped by their bytes, so nothing is removed because of a hash alone.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from playlake.llm.tables import attach, stage
from playlake.scratch import scratch_dir

# A chunk ends where the top CUT_BITS bits of the rolling hash over WINDOW units are zero, but has at
# least MIN_LINES units, or else more than PASSAGE_WORDS words; it has at most MAX_LINES units. Lines that are
# blank do not count. WINDOW is at most MIN_LINES, so what precedes a chunk does not matter.
# Units inside lines can be a word long. So a chunk of up to PASSAGE_WORDS words is made of whole sentences and has
# INSIDE_WORDS words, or it is made of MIN_LINES whole lines.
CUT_BITS = 1
WINDOW = 2
MIN_LINES = 2
MAX_LINES = 64
PASSAGE_WORDS = 50
INSIDE_WORDS = 12
FACTOR = 0x9E3779B97F4A7C15
BATCH_BYTES = 8_000_000

FIRST = "STRUCT<no_id: BOOLEAN, doc_id: BIGINT, text_hash: BIGINT, place: INT>"


# A unit ends at a line feed, at blanks after the end of a sentence and at blanks before a Latin, Greek or Cyrillic
# capital: a passage may begin after words without a full stop.
BLANKS = b" \t\x0b\x0c\r"
IS_SPACE = np.isin(np.arange(256), list(BLANKS + b"\n"))
IS_STOP = np.isin(np.arange(256), list(b".!?"))
# First bytes of capitals and, for those of two bytes, the second ones.
IS_CAPITAL = np.isin(np.arange(256), list(range(ord("A"), ord("Z") + 1)))
CAPITALS = {0xC3: [*range(0x80, 0x97), *range(0x98, 0x9F)], 0xCE: range(0x86, 0xAC), 0xD0: range(0x80, 0xB0)}
# Texts are cut up together, up to this many bytes at a time.
TOGETHER = 4_000_000


class Units:
    """Lines and parts of lines that are not blank, of texts that stand one after the other in `data`."""

    def __init__(self, data: bytes, bounds: np.ndarray):
        """Text d is data[bounds[d]:bounds[d + 1]]."""
        self.data, self.start, self.stop = data, bounds[:-1].tolist(), bounds[1:].tolist()
        raw = np.frombuffer(data, dtype=np.uint8)
        word = np.concatenate([[False], ~IS_SPACE[raw], [False]])
        # Words do not go on in the next text.
        apart = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(raw))]
        apart = np.unique(apart[word[apart] & word[apart + 1]])
        begin = np.sort(np.concatenate([np.flatnonzero(word[1:-1] & ~word[:-2]), apart]))
        end = np.sort(np.concatenate([np.flatnonzero(word[1:-1] & ~word[2:]) + 1, apart]))
        feeds = np.flatnonzero(raw == 10)
        # Line feeds before each word, and its text.
        line = np.cumsum(np.bincount(np.searchsorted(begin, feeds), minlength=len(begin)))[: len(begin)]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(begin, bounds)))
        opens = np.ones(len(begin), dtype=bool)
        opens[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        after_stop = np.zeros(len(begin), dtype=bool)
        after_stop[1:] = IS_STOP[raw[end[:-1] - 1]]
        capital = IS_CAPITAL[raw[begin]]
        second = raw[np.minimum(begin + 1, max(len(raw) - 1, 0))]
        for one, two in CAPITALS.items():
            lead = np.flatnonzero(raw[begin] == one)
            capital[lead] = np.isin(second[lead], list(two))
        first = np.flatnonzero(opens | after_stop | capital)
        last = np.append(first[1:], len(begin))[: len(first)] - 1
        self.starts, self.ends = begin[first], end[last]
        self.text, self.opens = text[first], opens[first]
        self.closes = np.append(self.opens[1:], True)[: len(first)]
        # Whether a sentence or a line begins, or ends, there.
        self.begins = self.opens | after_stop[first]
        self.stops = self.closes | IS_STOP[raw[self.ends - 1]]
        self.words = np.concatenate([[0], np.cumsum(last - first + 1)])
        line_start = np.maximum(np.append(feeds, 0)[line[first] - 1] + 1, bounds[self.text])
        line_start = np.where(line[first] > 0, line_start, bounds[self.text])
        # Where each begins with the blanks before it, if it is the first of its line.
        self.spans = np.where(self.opens, line_start, self.starts)
        # First unit of each text, and of the one after the last.
        self.base = np.searchsorted(self.text, np.arange(len(bounds)))

    def _cuts(self) -> np.ndarray:
        hashes = [xxhash.xxh3_64_intdigest(self.data[a:b]) for a, b in zip(self.starts.tolist(), self.ends.tolist())]
        hashes = np.array(hashes, dtype=np.uint64)
        rolling, factor = np.zeros(len(hashes), dtype=np.uint64), np.uint64(FACTOR)
        place = np.arange(len(hashes)) - self.base[self.text]
        for back in reversed(range(WINDOW)):
            rolling = rolling * factor + np.where(place >= back, np.roll(hashes, back), np.uint64(0))
        return ((rolling ^ rolling >> np.uint64(29)) * factor) >> np.uint64(64 - CUT_BITS) == 0

    def chunks(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last units of the chunks."""
        n = len(self.starts)
        first, never = np.arange(n), n + MAX_LINES
        if not n:
            return first, first
        cut = self._cuts()

        def following(flags: np.ndarray, least: np.ndarray) -> np.ndarray:
            """The next unit with a flag, from `least` on."""
            return np.append(np.flatnonzero(flags), never)[np.searchsorted(np.flatnonzero(flags), least)]

        two = first + MIN_LINES - 1
        long = np.searchsorted(self.words, self.words[:-1] + PASSAGE_WORDS, side="right") - 1
        enough = np.maximum(np.searchsorted(self.words, self.words[:-1] + INSIDE_WORDS) - 1, two)
        closing = np.flatnonzero(self.closes)
        nth = np.searchsorted(closing, first) + MIN_LINES - 1
        lines = np.maximum(np.append(closing, [never] * MIN_LINES)[nth], two)
        inside = np.where(self.begins, following(cut & self.stops, enough), never)
        whole = np.where(self.opens, following(cut & self.closes, lines), never)
        limit = np.minimum(self.base[self.text + 1] - 1, first + MAX_LINES - 1)
        end = np.minimum.reduce([long, inside, whole])
        # Without a cut it goes to the end of the text, if that is far enough.
        rest = (self.begins & self.stops[limit] & (enough <= limit)) | (self.opens & self.closes[limit] & (lines <= limit))
        found = np.flatnonzero((end <= limit) | rest)
        return found, np.minimum(end, limit)[found]

    def left(self, gone: np.ndarray) -> list[bytes]:
        """The texts without the chunks that start where `gone` is set, and without what is blank after these units.

        The line feeds after a line stay if a unit of this line does.
        """
        first, last = self.chunks()
        first, last = first[gone[first]], last[gone[first]]
        steps = np.zeros(len(self.starts) + 1, dtype=np.int64)
        np.add.at(steps, first, 1)
        np.add.at(steps, last + 1, -1)
        removed = np.cumsum(steps)[:-1] > 0
        out = []
        for d, (a, b) in enumerate(zip(self.base[:-1].tolist(), self.base[1:].tolist())):
            until = self.spans[a + 1 : b].tolist() + [self.stop[d]]
            parts, own = [self.data[self.start[d] : int(self.spans[a]) if a < b else self.stop[d]]], False
            for i, end in zip(range(a, b), until):
                own = own and not self.opens[i]
                if not removed[i]:
                    parts.append(self.data[self.spans[i] : end])
                    own = True
                elif own and self.closes[i]:
                    # What is left of the line ends as the line did, without the blanks before what went.
                    parts[-1] = parts[-1].rstrip(BLANKS)
                    parts.append(self.data[self.ends[i] : end])
            out.append(b"".join(parts))
        return out


def units(bodies: Sequence[bytes]) -> Iterator[tuple[int, Units]]:
    """Number of the first text, and units, of a few texts at a time."""
    at = 0
    while at < len(bodies):
        to, size = at, 0
        while to < len(bodies) and (to == at or size + len(bodies[to]) <= TOGETHER):
            size += len(bodies[to])
            to += 1
        bounds = np.cumsum([0, *(len(b) for b in bodies[at:to])])
        yield at, Units(b"".join(bodies[at:to]), bounds)
        at = to


def line_chunks(body: bytes) -> Iterator[tuple[int, int, bytes]]:
    """First unit, number of units and bytes of each chunk; lines that are blank are not counted."""
    for _, found in units([body]):
        for first, last in zip(*found.chunks()):
            yield int(first), int(last - first + 1), body[found.starts[first] : found.ends[last]]


def without_chunks(bodies: Sequence[bytes], places: Sequence[np.ndarray]) -> Iterator[bytes]:
    """The texts without their chunks that start at the units `places`."""
    for at, found in units(bodies):
        gone = np.zeros(len(found.starts), dtype=bool)
        for base, own in zip(found.base[:-1], places[at:]):
            gone[base + np.asarray(own, dtype=np.int64)] = True
        yield from found.left(gone)


def line_dedup(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64
) -> DataFrame:
    """One row per row: document (a struct of all columns), text (what is left of it), removed_chunks.

    The first place of a chunk is the one in the document with the smallest id (null last), then by hash
    of the text and by place in it. A unit is a line, cut after each . ! or ? and before each capital that
    has a blank there. It goes if a chunk over it stands at an earlier place as well, so of every unit that goes one
    that is equal but for blanks at its ends stays. Lines end with a line feed only; blanks after a unit go with it,
    and the line feed and blank lines after a line go if all of the line does. A unit of more than PASSAGE_WORDS words
    is a passage by itself; other single units stay, and so do fewer than INSIDE_WORDS words inside lines. Rows with
    equal id and text are one document and keep or lose the same chunks. A null text stays null and an
    empty one empty; a text may become empty. An empty table gives no rows.

    `hash_bits` shortens the chunk hash, to test what happens when chunks share one.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    places = stage(texts.mapInArrow(_chunk_places(hash_bits), f"hash BIGINT, here {FIRST}"), f"{work}/places")
    by_hash = places.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("here").alias("first"))
    repeated = stage(by_hash.where("n > 1"), f"{work}/repeated")
    suspects = stage(attach(places, repeated, "hash", "n").select("hash", "here", "first"), f"{work}/suspects")
    # Only chunks whose hash is repeated move with their bytes.
    doubtful = _with_places(texts, suspects)
    # Nothing is aggregated beside the bytes, so they are told apart by hashing and not by sorting.
    chunks = doubtful.mapInArrow(_chunk_bytes(hash_bits), "hash BIGINT, chunk BINARY").distinct()
    kinds = chunks.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds"))
    shared = stage(kinds.where("kinds > 1").select("hash"), f"{work}/shared")
    again = suspects.where("here != first")
    if not shared.isEmpty():
        again = again.join(shared, "hash", "left_anti").select("here").unionByName(
            _told_apart(texts, suspects.join(shared, "hash", "left_semi"), hash_bits, f"{work}/told_apart")
        )
    removed = stage(
        again.groupBy("here.doc_id", "here.text_hash").agg(F.collect_set("here.place").alias("places")),
        f"{work}/removed",
    )
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"),
        F.col(id_col).cast("bigint").alias("own_id"),
        F.xxhash64(body).alias("own_hash"),
    )
    # Sorted at every size: broadcasting a list that grows with the corpus would only work on small ones.
    joined = rows.join(
        removed.hint("merge"), rows.own_id.eqNullSafe(removed.doc_id) & (rows.own_hash == removed.text_hash), "left"
    )
    text = F.col(f"document.`{text_col}`")
    touched = F.when(F.col("places").isNotNull(), text.cast("binary"))
    left = F.when(F.col("places").isNull(), text).otherwise(without(touched, F.col("places")))
    return joined.select(
        "document", left.alias("text"), F.coalesce(F.size("places"), F.lit(0)).alias("removed_chunks")
    )


@F.pandas_udf(StringType())
def without(bodies: pd.Series, places: pd.Series) -> pd.Series:
    """The texts without the chunks at `places`."""
    wanted = [i for i, body in enumerate(bodies) if body is not None]
    out = pd.Series([None] * len(bodies), dtype=object)
    for i, body in zip(wanted, without_chunks([bodies[i] for i in wanted], [places[i] for i in wanted])):
        out[i] = body.decode()
    return out


def _with_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The texts that have some of `places`, with these."""
    marked = places.groupBy("here.doc_id", "here.text_hash").agg(F.collect_set("here.place").alias("places"))
    marked = marked.withColumnsRenamed({"doc_id": "marked_id", "text_hash": "marked_hash"})
    return texts.join(
        marked.hint("merge"),
        texts.doc_id.eqNullSafe(F.col("marked_id")) & (texts.text_hash == F.col("marked_hash")),
    ).select("doc_id", "text_hash", "body", "places")


def _told_apart(texts: DataFrame, suspects: DataFrame, hash_bits: int, path: str) -> DataFrame:
    """Places to remove among `suspects`, chunks that share a hash with others: these are joined on their bytes."""
    every = f"hash BIGINT, chunk BINARY, here {FIRST}"
    here = _with_places(texts, suspects).mapInArrow(_chunk_bytes(hash_bits, places=True), every)
    here = stage(here, path)
    first = here.groupBy("hash", "chunk").agg(F.min("here").alias("first"), F.count(F.lit(1)).alias("n"))
    key = F.struct("hash", "chunk").alias("key")
    found = attach(here.select(key, "here"), stage(first.select(key, "first", "n"), f"{path}_first"), "key", "n")
    return found.where("here != first").select("here")


def _name(chunk: bytes, hash_bits: int) -> int:
    drop = 64 - hash_bits
    # Signed, as Spark's long is.
    return (xxhash.xxh3_64_intdigest(chunk) >> drop) - (1 << 63 >> drop)


def _places_array(rows: list[tuple]) -> pa.StructArray:
    docs, hashes, places = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays(
        [
            pa.array([d is None for d in docs], pa.bool_()),
            pa.array(docs, pa.int64()),
            pa.array(hashes, pa.int64()),
            pa.array(places, pa.int32()),
        ],
        names=["no_id", "doc_id", "text_hash", "place"],
    )


def _chunk_bytes(hash_bits: int, places: bool = False):
    """Hash and bytes of the chunks at `places`, those of equal bytes once for many texts; with `places`, each with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set = set()
        held = 0

        def give() -> pa.RecordBatch:
            rows = list(found)
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
            if places:
                columns.append(_places_array([r[2] for r in rows]))
            found.clear()
            return pa.RecordBatch.from_arrays(columns, names=["hash", "chunk", "here"][: len(columns)])

        for batch in batches:
            docs, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            marked = batch.column("places")
            for at, units_of in units(batch.column("body").to_pylist()):
                texts = marked.slice(at, len(units_of.base) - 1)
                counts = np.diff(texts.offsets.to_numpy())
                wanted = np.zeros(len(units_of.starts), dtype=bool)
                wanted[np.repeat(units_of.base[:-1], counts) + texts.flatten().to_numpy()] = True
                first, last = units_of.chunks()
                chosen = wanted[first]
                first, last = first[chosen], last[chosen]
                bounds = zip(units_of.starts[first].tolist(), units_of.ends[last].tolist())
                pieces = [units_of.data[a:b] for a, b in bounds]
                if places:
                    text = units_of.text[first]
                    rows = zip(
                        [_name(c, hash_bits) for c in pieces],
                        pieces,
                        ((docs[at + t], hashes[at + t], p) for t, p in zip(text.tolist(), (first - units_of.base[text]).tolist())),
                    )
                    found.update(rows)
                    held += sum(map(len, pieces))
                else:
                    new = {(_name(c, hash_bits), c) for c in set(pieces)} - found
                    found |= new
                    held += sum(len(c) for _, c in new)
                if held > BATCH_BYTES:
                    held = 0
                    yield give()
        if found:
            yield give()

    return run


def _chunk_places(hash_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, found in units(batch.column("body").to_pylist()):
                first, last = found.chunks()
                bounds = zip(found.starts[first].tolist(), found.ends[last].tolist())
                texts = found.text[first]
                docs = batch.column("doc_id").take(pa.array(texts + at))
                here = [
                    docs.is_null(),
                    docs,
                    batch.column("text_hash").take(pa.array(texts + at)),
                    pa.array((first - found.base[texts]).astype(np.int32)),
                ]
                names = pa.array([_name(found.data[a:b], hash_bits) for a, b in bounds], pa.int64())
                here = pa.StructArray.from_arrays(here, names=["no_id", "doc_id", "text_hash", "place"])
                yield pa.RecordBatch.from_arrays([names, here], names=["hash", "here"])

    return run
