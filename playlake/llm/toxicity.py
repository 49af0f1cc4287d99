"""Toxicity by votes of the nearest labelled examples, found by exact TF-IDF cosine in a block-max inverted index.

Terms are words and the beginnings of words. Those whose presence speaks most for label 1 in a bounded sample of the
training documents are the vocabulary; its document frequencies are counted over all documents. The labelled
examples are bounded in number, so their index is, and every task gets it. Examples are laid out so that those with a
rare term in common stand together, in blocks. For each term the index has the greatest weight in
each block: with the weights of a document these give a bound for the block. Blocks are read from the greatest bound down until
the bound of the next falls below the kth best cosine.

The k nearest examples vote with a weight that falls with their distance. A logistic function, fitted to the votes that
examples get from the others, turns a vote into a score.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm.tables import id_and_bytes, stage
from playlake.scratch import scratch_dir

FOLDS = 5
# Bounds of the labelled sample: ids of each label, those with the smallest hashes, of which terms are counted;
# examples of each label among them; terms.
TRAINING = 20_000
EXAMPLES = 4096
VOCABULARY = 2048
# A term is in the vocabulary if at least so many training documents hold it, its chi-square statistic reaches this,
# and label 1 is so many times as frequent among them as among all.
LEAST_DOCUMENTS = 5
LEAST_CHI = 30.0
LEAST_LIFT = 3.0
NEIGHBOURS = 15
BLOCK = 32
# Blocks read in the first step; every further step of a search reads four times as many.
FIRST_BLOCKS = 8
# Added to a distance before it is turned into a weight, and to the votes in favour of the share among examples.
NEAREST = 0.1
PRIOR_WEIGHT = 0.5
# Digits of a cosine. Bounds are sums of doubles in another order, and may be off by far less than SLACK.
DIGITS = 12
SLACK = 1e-9
# Lengths of the beginnings of words that are terms, and the bytes from which a word is no term.
BEGINNINGS = (4, 5)
LONGEST = 60
# Words whose places a worker remembers, terms that it counts before it hands them on, and bytes of a text at a time.
REMEMBERED = 300_000
SCORED_ROWS = 10_000
COUNTED = 400_000
PIECE = 1 << 20

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

VECTOR_SCHEMA = "doc_id BIGINT, terms ARRAY<INT>, tf ARRAY<INT>"
SCORE_SCHEMA = (
    "doc_id BIGINT, held_out BOOLEAN, score DOUBLE, predicted INT, "
    "neighbours ARRAY<STRUCT<doc_id: BIGINT, label: INT, cosine: DOUBLE>>"
)


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _held_out(doc: int | None) -> bool:
    return doc is None or crc32(str(doc).encode()) % FOLDS == 0


def score_documents(
    documents: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    examples: int = EXAMPLES,
    vocabulary: int = VOCABULARY,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted and the nearest examples, best first, as evidence.

    `labels` has the ids and their labels 0 or 1; null ids and labels are left out, and an id with several labels has
    the greatest. Held out, and not learnt from, are rows whose id, as decimal text, has a CRC-32 divisible by 5 and
    rows without an id. A null text is empty. A text without a term of the vocabulary has no neighbours; its score is the one
    of a vote without voters. Equal cosines go to the example with the smaller id. Rows that repeat an id are documents and
    examples of their own. Without training documents of both labels all scores are the share of label 1
    among the training labels, 0 without any. Other columns, and those of `labels`, are not read. An empty table gives no rows.
    """
    spark = documents.sparkSession
    work = scratch_dir(spark)
    texts = id_and_bytes(documents, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("label IN (0, 1)").where(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))

    known = stage(known, f"{work}/known")
    sizes = dict(known.groupBy("label").count().collect())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = [known.where(F.col("label") == label).orderBy(*order).limit(TRAINING) for label in (0, 1)]
    # At most 2 * TRAINING ids.
    sample = F.broadcast(stage(sample[0].unionAll(sample[1]), f"{work}/sample"))
    terms = _vocabulary(texts.join(sample, "doc_id"), vocabulary, f"{work}/told")
    vectors = stage(texts.mapInArrow(_vectors(terms), VECTOR_SCHEMA), f"{work}/vectors")
    n_documents = vectors.count()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = np.zeros(len(terms))
    for row in df.collect():  # one row per term of the vocabulary
        idf[row["term"]] = math.log((1 + n_documents) / (1 + row["df"])) + 1

    labelled = vectors.join(sample, "doc_id")
    order += [F.col("terms"), F.col("tf")]
    drawn = [labelled.where(F.col("label") == label).orderBy(*order).limit(examples) for label in (0, 1)]
    rows = drawn[0].unionAll(drawn[1]).collect()  # bounded by `examples` and `vocabulary`
    found = Counter(row["label"] for row in rows)
    total = sum(sizes.values())
    if len(found) < 2:
        model = Model(None, 0.0, sizes.get(1, 0) / total if total else 0.0, neighbours)
    else:
        # What an example of each label stands for.
        weight = {label: sizes[label] / n for label, n in found.items()}
        index = BlockMax(
            [(r["doc_id"], r["label"], weight[r["label"]], np.array(r["terms"], int), np.array(r["tf"], float)) for r in rows], idf
        )
        model = Model(index, sizes[1] / total, None, neighbours)
        votes = spark.createDataFrame([(i,) for i in range(len(rows))], "place INT").mapInArrow(
            model.votes_of_examples, "vote DOUBLE, label INT, weight DOUBLE"
        ).collect()
        model.calibrate(*(np.array(c) for c in zip(*votes)))
    # A row of the vectors is small and takes long.
    tasks = -(-n_documents // SCORED_ROWS)
    return (vectors.repartition(tasks) if tasks > 1 else vectors).mapInArrow(model.scores, SCORE_SCHEMA)


def terms_of(word: bytes) -> tuple[bytes, ...]:
    """The word itself unless it is very long, and its beginnings by letters. A star marks these; no word holds one."""
    letters = word if word.isascii() else word.decode(errors="replace")
    starts = [letters[:n] for n in BEGINNINGS if len(letters) > n]
    if not word.isascii():
        starts = [s.encode() for s in starts]
    return tuple([s + b"*" for s in starts] + [word] * (len(word) < LONGEST))


def words(body: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A to Z lower-cased, some at a time. A piece ends at a blank if it has one."""
    at = 0
    while at < len(body):
        end = body.find(b" ", at + PIECE)
        end = len(body) if end < 0 else end
        yield WORD.findall(body[at:end].lower())
        at = end


def _vocabulary(training: DataFrame, limit: int, path: str) -> list[bytes]:
    """Terms whose presence speaks most for label 1, by the chi-square statistic over the training documents."""
    told = stage(
        training.mapInArrow(_presence, "term BINARY, n BIGINT, toxic BIGINT")
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).where(F.col("n") >= LEAST_DOCUMENTS),
        path,
    )
    total, toxic = training.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < total:
        return []
    a, n = F.col("toxic").cast("double"), F.col("n").cast("double")
    off = a - n * (toxic / total)
    chi = off * off / (n * (toxic / total) * (1 - toxic / total) * (1 - n / (total + 1)))
    told = told.where(a >= n * (LEAST_LIFT * toxic / total))
    best = told.withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "term").limit(limit)
    return sorted(bytes(row["term"]) for row in best.select("term").collect())


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, and those of label 1, that hold each term."""
    counts = ({}, {})

    def counted() -> pa.RecordBatch:
        terms = list(counts[0].keys() | counts[1].keys())
        toxic = [counts[1].get(t, 0) for t in terms]
        n = [counts[0].get(t, 0) + of for t, of in zip(terms, toxic)]
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(toxic, pa.int64())], names=["term", "n", "toxic"]
        )

    for batch in batches:
        for body, label in zip(batch.column("body"), batch.column("label").to_pylist()):
            found = set()
            for some in words(body.as_py()):
                found.update(some)
            of = counts[label]
            for term in {t for word in found for t in terms_of(word)}:
                of[term] = of.get(term, 0) + 1
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield counted()
                counts = ({}, {})
    yield counted()


def _vectors(vocabulary: list[bytes]):
    """How often each document holds each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary)}
        known: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            terms, tf = [], []
            for body in batch.column("body"):
                said = Counter()
                for some in words(body.as_py()):
                    said.update(some)
                counts: dict[int, int] = {}
                for word, n in said.items():
                    places = known.get(word)
                    if places is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        places = known[word] = tuple(place[t] for t in terms_of(word) if t in place)
                    for at in places:
                        counts[at] = counts.get(at, 0) + n
                found = sorted(counts)
                terms.append(found)
                tf.append([counts[t] for t in found])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(terms, kind), pa.array(tf, kind)], names=["doc_id", "terms", "tf"]
            )

    return run


class BlockMax:
    """Labelled examples by term, with the greatest weight of every term in every block of examples."""

    def __init__(self, examples: list[tuple], idf: np.ndarray):
        self.idf = idf
        weighed = [(doc, label, of, terms, self.weights(terms, tf)) for doc, label, of, terms, tf in examples]
        # Examples with the same heaviest term stand together, so that the bounds of blocks differ.
        def heaviest(example):
            by = np.argsort(-example[4], kind="stable")[:2]
            return [int(example[3][i]) for i in by]

        weighed.sort(key=lambda e: (heaviest(e), e[0]))
        self.docs = np.array([e[0] for e in weighed], dtype=np.int64)
        self.labels = np.array([e[1] for e in weighed], dtype=np.int64)
        self.stand_for = np.array([e[2] for e in weighed])
        self.vectors = [(e[3], e[4]) for e in weighed]
        self.blocks = -(-len(weighed) // BLOCK)
        # Postings by term and then by example; where each block of a term begins; a term's greatest weight in a block.
        sizes = [len(terms) for terms, _ in self.vectors]
        terms = np.concatenate([terms for terms, _ in self.vectors])
        weights = np.concatenate([own for _, own in self.vectors])
        places = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((places, terms))
        self.places, self.own = places[order], weights[order]
        cells = terms[order] * self.blocks + self.places // BLOCK
        self.starts = np.searchsorted(cells, np.arange(len(idf) * self.blocks + 1))
        self.most = np.zeros(len(idf) * self.blocks)
        np.maximum.at(self.most, cells, self.own)
        self.most = self.most.reshape(len(idf), self.blocks)

    def weights(self, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """TF-IDF of length 1."""
        weights = (1 + np.log(tf)) * self.idf[terms]
        return weights / np.sqrt((weights**2).sum()) if len(weights) else weights

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the `k` nearest examples with a cosine above 0, other than the one at `but`.

        Equal ones go to the smaller id.
        """
        best, cosines = np.empty(0, dtype=np.int64), np.empty(0)
        bounds = weights @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds)]
        at, width = 0, FIRST_BLOCKS
        while at < len(order) and not (len(best) == k and bounds[order[at]] < cosines[-1] - SLACK):
            # The postings of all terms in the next blocks, in the order of terms.
            cells = (terms[:, None] * self.blocks + np.sort(order[at : at + width])).ravel()
            first = self.starts[cells]
            sizes = self.starts[cells + 1] - first
            held = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
            of_term = np.repeat(weights, sizes.reshape(len(terms), -1).sum(axis=1))
            # Rounded, so that examples of one direction tie.
            sums = np.round(np.bincount(self.places[held], of_term * self.own[held]), DIGITS)
            if 0 <= but < len(sums):
                sums[but] = 0
            if len(best) == k:
                sums[sums < cosines[-1]] = 0
            places = np.flatnonzero(sums)
            best, cosines = np.concatenate([best, places]), np.concatenate([cosines, sums[places]])
            keep = np.lexsort((best, self.docs[best], -cosines))[:k]
            best, cosines = best[keep], cosines[keep]
            at += width
            width *= 4
        return best, cosines


@dataclass
class Model:
    index: BlockMax | None
    share: float
    # The score of everything, if there is nothing to compare with.
    constant: float | None
    neighbours: int
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of label 1 among the neighbours, each by its distance and by what it stands for."""
        # Falls with the distance, to nothing at a right angle.
        weight = self.index.stand_for[places] * (1 / (NEAREST + 1 - np.minimum(cosines, 1.0)) - 1 / (NEAREST + 1))
        ones = float((weight * self.index.labels[places]).sum()) + PRIOR_WEIGHT * self.share
        return math.log(ones / (float(weight.sum()) + PRIOR_WEIGHT - ones))

    def votes_of_examples(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vote that each example gets from all others."""
        index = self.index
        for batch in batches:
            places = batch.column("place").to_pylist()
            votes = [self.vote(*index.nearest(*index.vectors[p], self.neighbours, but=p)) for p in places]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(votes, pa.float64()),
                    pa.array(index.labels[places].astype(np.int32)),
                    pa.array(index.stand_for[places]),
                ],
                names=["vote", "label", "weight"],
            )

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Fit the logistic function of the vote by Newton's method, with a slope above 0."""
        beta, design = np.array([1.0, 0.0]), np.column_stack([votes, np.ones(len(votes))])
        # A weak pull towards the vote as it is, which also ends the fit if one threshold parts the labels.
        pull = np.array([1.0, 1e-3])

        def loss(beta: np.ndarray) -> float:
            against = np.where(labels == 1, -1.0, 1.0) * (design @ beta)
            return float((weights * np.logaddexp(0, against)).sum() + (pull * (beta - [1.0, 0.0]) ** 2).sum() / 2)

        for _ in range(100):
            chance = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
            gradient = design.T @ (weights * (labels - chance)) - pull * (beta - [1.0, 0.0])
            curve = (design * (weights * chance * (1 - chance))[:, None]).T @ design + np.diag(pull)
            step = np.linalg.solve(curve, gradient)
            while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
                step /= 2
            beta = beta + step
            if np.abs(step).max() <= 1e-9:
                break
        self.slope, self.shift = max(float(beta[0]), 0.05), float(beta[1])

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            scores, evidence = [], []
            for terms, tf in zip(batch.column("terms"), batch.column("tf")):
                score, near = self._score(np.array(terms.as_py(), dtype=np.int64), np.array(tf.as_py(), dtype=float))
                scores.append(score)
                evidence.append(near)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array([_held_out(d) for d in docs]),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(evidence, pa.list_(pa.struct({"doc_id": pa.int64(), "label": pa.int32(), "cosine": pa.float64()}))),
                ],
                names=["doc_id", "held_out", "score", "predicted", "neighbours"],
            )

    def _score(self, terms: np.ndarray, tf: np.ndarray) -> tuple[float, list[dict]]:
        if self.constant is not None:
            return self.constant, []
        places, cosines = self.index.nearest(terms, self.index.weights(terms, tf), self.neighbours)
        score = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.vote(places, cosines) + self.shift))))
        index = self.index
        return score, [
            {"doc_id": int(index.docs[p]), "label": int(index.labels[p]), "cosine": float(c)} for p, c in zip(places, cosines)
        ]
