import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import zstandard

from playlake.llm import pitman_yor
from playlake.llm.pitman_yor import (
    END, Block, Parent, Seatings, draw_tables, is_held_out, log_weights, predictive, score_documents, scored, squeeze, unsqueeze,
)

SCHEMA = "doc_id BIGINT, text STRING"


def hand_scores(rows):
    tokens = [(d, [*(t or "").encode().lower().split(), END]) for d, t in rows]
    counts = Counter(w for d, ws in tokens if not is_held_out(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (str(d), is_held_out(d), len(ws), sum(counts[w] > 0 for w in ws), n,
         round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6))
        for d, ws in tokens
    )


def told(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_counts_and_base_scores_equal_hand_counts_and_the_model_is_better(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scores = score_documents(documents.repartition(5)).cache()
    assert told(scores) == hand_scores([tuple(r) for r in documents.collect()])
    for row in scores.groupBy("held_out").agg({"score": "sum", "base_score": "sum"}).collect():
        assert row["sum(score)"] > row["sum(base_score)"]


def test_awkward_rows(spark):
    rows = [(1, "A b\x0bc"), (1, "A b\x0bc"), (2, None), (3, ""), (None, "a a"), (4, "é É \x85 x"), (5, "w " * 70_000), (6, " \t")]
    assert any(is_held_out(d) for d, _ in rows) and crc32(b"") % 10 == 0
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", word INT, block INT").repartition(3)
    scores = score_documents(df)
    assert told(scores) == hand_scores(rows)
    assert all(-1e7 < r.score <= 1e-9 for r in scores.collect())


def test_without_training_rows_and_empty(spark):
    only = next(d for d in range(1000) if is_held_out(d))
    row = score_documents(spark.createDataFrame([(only, "a b")], SCHEMA)).first()
    assert (row.n_known, row.train_tokens, row.score, row.base_score) == (0, 0, 0.0, 0.0)
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_probabilities_sum_to_one():
    """Of all known words and the unknown one, after each context, an unknown one too."""
    rng = np.random.default_rng(1)
    words, contexts, samples = 40, 12, 3
    c = rng.integers(0, 9, (contexts, words))
    c[:, 0] = 1
    t = np.stack([np.minimum(c, rng.integers(1, 4, c.shape)) for _ in range(samples)])
    root_c = np.c_[t.sum(axis=1), np.zeros(samples, int)]
    root_t = np.minimum(root_c, 2)
    sampled = [Parent(int(n.sum()), int(m.sum()), words, 0.7, 0.6) for n, m in zip(root_c, root_t)]
    customers, context_t = np.r_[c.sum(axis=1), 0], np.c_[t.sum(axis=2), np.zeros(samples, int)]
    context, word = (x.ravel() for x in np.indices((contexts + 1, words + 1)))
    padded = np.pad(c, ((0, 1), (0, 1))).ravel()
    sum_t = np.pad(t.sum(axis=0), ((0, 1), (0, 1))).ravel()
    chance = predictive(sampled, context, word, padded, sum_t, customers, context_t, root_c, root_t)
    assert np.allclose(chance.reshape(contexts + 1, words + 1).sum(axis=1), 1)


def partitions(customers):
    """All ways to seat customers, as the sizes of the tables, with how often each comes."""
    seatings = {(): 1}
    for _ in range(customers):
        more = Counter()
        for sizes, n in seatings.items():
            more[tuple(sorted((*sizes, 1)))] += n
            for i in range(len(sizes)):
                more[tuple(sorted((*sizes[:i], sizes[i] + 1, *sizes[i + 1 :])))] += n
        seatings = more
    return seatings


def posterior(c, others, parent, discount):
    """Chances of the numbers of tables by enumeration of all seatings, each with its own probability."""
    weight = Counter()
    for sizes, n in partitions(c).items():
        of_tables = math.prod((1 + discount * (others + i)) * parent for i in range(len(sizes)))
        of_seats = math.prod(k - discount for size in sizes for k in range(1, size))
        weight[len(sizes)] += n * of_tables * of_seats
    return np.array([weight[t] for t in range(1, c + 1)]) / sum(weight.values())


@pytest.mark.parametrize("discount", [0.05, 0.5, 0.8, 0.95])
@pytest.mark.parametrize("others, parent", [(0, 0.5), (20, 0.01), (1000, 0.001), (50, 0.9)])
def test_tables_are_drawn_given_all_customers(discount, others, parent):
    draw = np.random.default_rng(2)
    for c in range(2, 9):
        expected = posterior(c, others, parent, discount)
        weights = log_weights(c, np.array([others]), np.array([parent]), discount)[0]
        assert np.exp(weights - weights.max()) / np.exp(weights - weights.max()).sum() == pytest.approx(expected, rel=1e-9)
        n = 20_000
        tables = draw_tables(np.full(n, c), np.full(n, others), np.full(n, parent), discount, draw)
        mean, spread = (expected * np.arange(1, c + 1)).sum(), tables.std() / math.sqrt(n)
        assert abs(tables.mean() - mean) < 5 * spread + 1e-3


def test_a_sampler_that_moves_one_customer_at_a_time_agrees():
    """Fifty customers, moved one by one given all others for many rounds."""
    draw, c, others, parent, discount = np.random.default_rng(3), 50, 1000, 0.001, 0.8
    sizes, seen = [1] * c, []
    for step in range(120_000):
        at = draw.choice(len(sizes), p=np.array(sizes) / c)
        sizes[at] -= 1
        if not sizes[at]:
            del sizes[at]
        weights = [s - discount for s in sizes] + [(1 + discount * (others + len(sizes))) * parent]
        at = draw.choice(len(weights), p=np.array(weights) / sum(weights))
        sizes = sizes + [1] if at == len(sizes) else [s + (i == at) for i, s in enumerate(sizes)]
        if step > 2000:
            seen.append(len(sizes))
    tables = draw_tables(np.full(20_000, c), np.full(20_000, others), np.full(20_000, parent), discount, draw)
    assert abs(tables.mean() - np.mean(seen)) < 0.1


@pytest.mark.parametrize("discount", [0.5, 0.8])
def test_rows_beyond_the_table_follow_by_scaling(monkeypatch, discount):
    exact = Seatings(discount).row(3000)
    monkeypatch.setattr(pitman_yor, "TABLED", 1536)
    scaled = Seatings(discount).row(3000)
    t = np.arange(len(scaled))
    for rate in (0.01, 1.0, 5.0):
        both = [np.exp(w - w.max()) / np.exp(w - w.max()).sum() for w in (r[: len(t)] + t * np.log(rate) for r in (exact, scaled))]
        means = [(p * (t + 1)).sum() for p in both]
        assert abs(means[0] - means[1]) < 0.03 * means[0]


def test_few_and_very_many_customers():
    draw = np.random.default_rng(4)
    c = np.array([0, 1, 2, 5000, 10_000_000])
    many = draw_tables(c, np.array([0, 0, 0, 5, 9]), np.full(5, 0.01), 0.5, draw)
    assert many[0] == 0 and many[1] == 1 and 1 <= many[2] <= 2 and all(1 <= t < n for t, n in zip(many[3:], c[3:]))


def test_squeeze():
    for kind in (np.uint8, np.int32, np.int64):
        numbers = np.arange(-5, 1000).astype(kind)
        assert (unsqueeze(squeeze(numbers), kind) == numbers).all()
    assert len(unsqueeze(squeeze(np.zeros(0, dtype=np.int32)), np.int32)) == 0


def test_the_word_before_counts_whatever_it_is(spark):
    # 300 words, each as frequent as the others and each followed by one other: no few contexts tell them apart.
    train = [d for d in range(4000) if not is_held_out(d)][:600]
    held = next(d for d in range(5000, 6000) if is_held_out(d))
    rows = [(d, f"a{i % 300} b{i % 300}") for i, d in enumerate(train)]
    rows += [(held, "a7 b7"), (held, "a7 b8")]
    scores = score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3))
    told, other = (r.score for r in scores.where("held_out").orderBy("score", ascending=False).collect())
    assert told - other > 1.5


def test_scores_equal_the_average_of_samples_by_hand_where_all_pairs_are_single(spark):
    # Pairs that occur once have one table, so only the parent's tables are drawn; with one word per pair none is.
    train = [d for d in range(100) if not is_held_out(d)][0]
    row = score_documents(spark.createDataFrame([(train, "x y z")], SCHEMA)).first()
    discount = root_discount = 0.95
    own = (1 - discount) / 2 + (1 + discount) / 2 * ((1 - root_discount) / 5 + (1 + root_discount * 4) / 5 / 5)
    assert abs(row.score - 4 * math.log10(own)) < 1e-9


def test_score_averages_the_whole_probability_of_each_sample():
    # One held-out text "a b": pairs a-b, b-END and START-a; places of words a, b, END and START are 0 to 3.
    sampled = [Parent(10, 6, 3, 0.5, 0.4), Parent(25, 9, 3, 0.5, 0.4)]
    block = Block({
        "words": zstandard.ZstdCompressor().compress(b"a b " + END), "tokens": squeeze(np.array([0, 1, 2], dtype=np.int32)),
        "lengths": squeeze(np.array([3])), "held_out": squeeze(np.array([1], dtype=np.uint8)),
    })
    block.find_pairs()
    words = {0: ([4, 9], [2, 3]), 1: ([3, 8], [1, 2]), 2: ([3, 8], [3, 4])}
    contexts = {0: (6, [2, 5]), 1: (5, [3, 4]), 3: (4, [1, 3])}
    pairs = {0: (4, 3), 2: (3, 5)}
    c, sum_t = (np.array([pairs.get(p, (0, 0))[i] for p in range(3)]) for i in range(2))
    n = np.array([7 * (p in words) for p in range(4)])
    customers = np.array([contexts.get(p, (0,))[0] for p in range(4)])
    context_t = [np.array([contexts[p][1][i] if p in contexts else 0 for p in range(4)]) for i in range(2)]
    root_c, root_t = ([np.array([words[p][k][i] if p in words else 0 for p in range(4)]) for i in range(2)] for k in range(2))
    got = scored(block, [1], sampled, 21, c, sum_t, n, customers, context_t, root_c, root_t)
    want = 0
    for place, context, word in ((0, 0, 1), (1, 1, 2), (2, 3, 0)):
        c, sum_t = pairs.get(place, (0, 0))
        customers, tables = contexts[context]
        each = []
        for i, parent in enumerate(sampled):
            new = (1 + 0.4 * parent.tables) / (1 + parent.customers) / 4
            root = (words[word][0][i] - 0.4 * words[word][1][i]) / (1 + parent.customers) + new
            each.append((c - 0.5 * sum_t / 2) / (1 + customers) + (1 + 0.5 * tables[i]) / (1 + customers) * root)
        want += math.log10(sum(each) / 2)
    assert abs(got.column("score")[0].as_py() - want) < 1e-12


def test_many_small_buckets_and_blocks_give_the_same_counts(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r for r in score_documents(documents.repartition(2)).collect()}
    for name, size in (("BUCKET_WORDS", 3000), ("BUCKET_TOKENS", 2000)):
        monkeypatch.setattr(pitman_yor, name, size)
    many = {r.doc_id: r for r in score_documents(documents.repartition(7)).collect()}
    assert one.keys() == many.keys()
    for doc, row in one.items():
        other = many[doc]
        assert row[:5] == other[:5] and row.base_score == pytest.approx(other.base_score)
    # Other draws only, which move a short text by a few percent and all together by little.
    assert sum(r.score for r in one.values()) == pytest.approx(sum(r.score for r in many.values()), rel=0.005)


def test_probabilities_of_whole_texts_sum_to_one(spark):
    """Of texts up to two words, as scored by the job, those after the start and after each word follow."""
    words = ["a", "b", "c", "unknown"]
    ids = iter(range(10**6))
    train = [d for d, _ in zip((d for d in range(10**6) if not is_held_out(d)), range(40))]
    rng = np.random.default_rng(7)
    rows = [(d, " ".join(rng.choice(words[:3], rng.integers(0, 9), p=[0.6, 0.3, 0.1]))) for d in train]
    texts = ["", *words, *(f"{w} {v}" for w in words for v in words)]
    held = dict(zip((d for d in ids if is_held_out(d)), texts))
    df = spark.createDataFrame([*rows, *held.items()], SCHEMA).repartition(3)
    chance = {held[r.doc_id]: 10**r.score for r in score_documents(df).where("held_out").collect()}
    # With x the inverse chances of the end after each word: all that may follow a word sums to one, so (I - ratio) x = 1.
    ratio = np.array([[chance[f"{w} {v}"] / chance[w] for v in words] for w in words])
    x = np.linalg.solve(np.eye(4) - ratio, np.ones(4))
    assert (x > 1).all()
    assert sum(chance[w] * k for w, k in zip(words, x)) + chance[""] == pytest.approx(1, abs=1e-9)
