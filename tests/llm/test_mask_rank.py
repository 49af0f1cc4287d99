import math
import re
from collections import Counter

import numpy as np
import pytest

from oracle import connect, rows_of_frame, rows_of_sql
from conftest import SF_DIR
from playlake.llm import mask_rank
from playlake.llm.mask_rank import group_by_mask, rank_items
from playlake.llm.queries import LLM_ORACLES, LLM_QUERIES

DOCS = "doc_id BIGINT, text STRING"
ITEMS = "item_id BIGINT, text STRING"


def said(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def brute(items, docs, k):
    counted = [(doc, Counter(said(text))) for doc, text in docs if said(text)]
    n, tokens = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(said(text))
    out = set()
    for item, wanted in asked.items():
        scored = []
        for doc, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // tokens
            score = 0
            for term, times in wanted.items():
                if term in c:
                    w = math.floor(1000 * math.log(float(2 * n + 2) / float(2 * df[term] + 1)))
                    score += times * w * ((1000000000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out |= {(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k])}
    return out


def ranked(spark, items, docs, k, partitions=3):
    found = rank_items(spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, DOCS).repartition(partitions), k)
    return [tuple(r) for r in found.collect()]


def random_rows(seed, n, words):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Ñandú", "straße", "x9", "日本"]
    sizes = rng.integers(0, 40, n)
    return [(i, " ".join(vocabulary[min(int(x), len(vocabulary) - 1)] for x in rng.zipf(1.3, s))) for i, s in enumerate(sizes)]


@pytest.mark.parametrize("query_terms", [50_000, 9])
def test_equals_brute_force(spark, monkeypatch, query_terms):
    docs, items = random_rows(1, 400, 60), random_rows(2, 25, 60)
    monkeypatch.setattr(mask_rank, "QUERY_TERMS", query_terms)
    found = ranked(spark, items, docs, 5)
    assert len(found) == len(set(found))
    assert set(found) == brute(items, docs, 5)


@pytest.mark.parametrize("block_docs, cells, masks", [(9, 1 << 24, 1), (50, 40, 2), (1000, 8, 16)])
def test_blocks_in_one_process_equal_brute_force(monkeypatch, block_docs, cells, masks):
    import pyarrow as pa

    for name, value in (("BLOCK_DOCS", block_docs), ("CELLS", cells), ("FIRST_MASKS", masks)):
        monkeypatch.setattr(mask_rank, name, value)
    monkeypatch.setattr(mask_rank.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    docs, items = random_rows(3, 300, 40), random_rows(4, 20, 40)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([d for d, _ in docs], pa.int64()), "body": pa.array([t.encode() for _, t in docs], pa.binary())
    })
    n = sum(1 for _, t in docs if said(t))
    tokens = sum(len(said(t)) for _, t in docs)
    df = Counter(t for _, text in docs for t in set(said(text)))
    best = {item: [] for item, _ in items}
    blocks = [b.to_pylist()[0] for b in mask_rank._blocks(iter([batch]))]
    assert len(blocks) == -(-n // block_docs)
    for row in blocks:
        block = mask_rank._Block(row, n, tokens)
        for item, text in items:
            wanted = [(t, c) for t, c in Counter(said(text)).items() if t in df]
            weights = [c * math.floor(1000 * math.log(float(2 * n + 2) / float(2 * df[t] + 1))) for t, c in wanted]
            mask_rank.rank_block(block, ([t.encode() for t, _ in wanted], weights), 4, best[item])
    found = {(item, r + 1, -i, s) for item, held in best.items() for r, (s, _, i) in enumerate(sorted(held, reverse=True))}
    assert found == brute(items, docs, 4)


def test_few_masks_are_evaluated(monkeypatch):
    """Later masks that cannot reach the ranking are left out."""
    scored = []
    monkeypatch.setattr(mask_rank, "_enter", lambda best, k, scores, rows, ids, enter=mask_rank._enter: (
        scored.append(len(rows)), enter(best, k, scores, rows, ids)))
    n = 5000
    block = mask_rank._Block.__new__(mask_rank._Block)
    block.docs = list(range(n))
    rare, common = np.arange(0, n, 500), np.arange(n)
    known = {b"rare": (rare, np.full(len(rare), 100), 100), b"common": (common, np.full(n, 100), 100)}
    block.postings = known.get
    best = []
    mask_rank.FIRST_MASKS, before = 1, mask_rank.FIRST_MASKS
    try:
        mask_rank.rank_block(block, ([b"rare", b"common"], [9, 1]), 5, best)
    finally:
        mask_rank.FIRST_MASKS = before
    assert sum(scored) == len(rare)
    assert sorted(-i for _, _, i in best) == [0, 500, 1000, 1500, 2000]


def test_grouping_by_mask():
    postings = [np.array([0, 2, 4, 6]), np.array([2, 3, 6]), np.array([9])]
    docs, starts, masks = group_by_mask(postings, 0, 8)
    groups = {tuple(m): sorted(g.tolist()) for m, g in zip(masks, np.split(docs, starts[1:]))}
    assert groups == {(1, 0, 0): [0, 4], (1, 1, 0): [2, 6], (0, 1, 0): [3]}
    docs, starts, masks = group_by_mask([np.array([i % 90]) for i in range(200)], 0, 90)
    assert len(docs) == len(starts) == 90 and masks.shape == (90, 200)


def test_awkward_rows(spark):
    long = "häufig " * 20_000 + "x" * 300_000
    docs = [(1, "A a-b"), (2, None), (3, ""), (4, "a b"), (4, "a b"), (None, "a b"), (5, "..."), (6, long), (7, "É é")]
    items = [(1, "a B"), (1, "b"), (2, None), (3, ""), (None, "é a"), (9, "unknown"), (8, "häufig " + "x" * 300_000)]
    found = ranked(spark, items, docs, 4)
    assert len(found) == len(set(found)) and set(found) == brute(items, docs, 4)
    assert [r[2] for r in sorted(f for f in found if f[0] == 1)] == [1, 4, 4, None]
    assert {r[0] for r in found} == {1, None, 8}


def test_empty_tables_and_other_columns(spark):
    assert ranked(spark, [], [(1, "a")], 3) == []
    assert ranked(spark, [(1, "a")], [], 3) == []
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (2, "c", 6, "y")], "doc_id INT, text STRING, score INT, terms STRING")
    items = spark.createDataFrame([(3, "a", "z")], "item_id INT, text STRING, block STRING")
    assert {tuple(r) for r in rank_items(items, docs, 3).collect()} == brute([(3, "a")], [(1, "a b"), (2, "c")], 3)


def test_query_equals_sql(spark):
    name = "op11_mask_rank"
    columns, rows = rows_of_frame(LLM_QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == rows_of_sql(connect(SF_DIR), LLM_ORACLES[name])
    assert rows
