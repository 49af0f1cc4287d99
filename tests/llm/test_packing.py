import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from playlake.llm.byte_pairs import byte_pairs
from playlake.llm.packing import Limits, pack, pack_texts, pack_tokens


def check(documents, limits):
    """Every token in one piece, every limit kept, every sequence full or a power of two."""
    covered = {i: [] for i, (_, ids, _) in enumerate(documents) if len(ids)}
    padding = 0
    for sequence in pack([(i, ids, loss) for i, (_, ids, loss) in enumerate(documents)], limits):
        tokens = sum(p.tokens for p in sequence)
        assert 0 < tokens <= limits.tokens and len(sequence) <= limits.segments
        assert sum(p.loss_tokens for p in sequence) <= limits.loss_tokens
        assert tokens == limits.tokens or tokens & (tokens - 1) == 0
        padding += 0 if tokens & (tokens - 1) == 0 else limits.tokens - tokens
        for p in sequence:
            assert p.loss_tokens == documents[p.doc][2][p.start : p.end].sum()
            covered[p.doc].append((p.start, p.end))
    for i, spans in covered.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] == len(documents[i][1])
    return padding


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 90), st.integers(0, 3)), max_size=60),
    st.sampled_from([Limits(16, 3, 16), Limits(32, 100, 5), Limits(24, 4, 24), Limits(8, 1, 3), Limits(64, 2, 40)]),
)
def test_limits_and_cover_hold(shapes, limits):
    documents = []
    for n, kind in shapes:
        flags = [np.ones(n), np.zeros(n), np.arange(n) % 2, np.arange(n) >= n // 2][kind]
        documents.append((None, np.arange(n, dtype=np.uint32), flags.astype(np.int32)))
    check(documents, limits)


def test_large_pool():
    rng = np.random.default_rng(1)
    documents = [(None, np.arange(n), np.ones(n, dtype=np.int32)) for n in rng.integers(1, 5000, 6000)]
    assert check(documents, Limits()) == 0


TEXTS = [
    (1, "Hello world, it's  me.\n\n x"), (2, None), (3, ""), (4, "<|endoftext|> a<|endoftext|>"), (5, "é 日本語   😀​\r\n"),
    (5, "é 日本語   😀​\r\n"), (None, "null id"), (6, "word " * 4000), (7, "a" * 3000), (8, "ſtÅ1²³ ٣'S 'll'D"),
]


def test_ids_are_those_of_the_tokenizers_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = byte_pairs()()
    texts = [t or "" for _, t in TEXTS]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    own = [i.tolist() for i in encode([t.encode() for t in texts])]
    assert own == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = test_ids_of_any_text.__dict__.setdefault(
        "library", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    )
    if any(0xD800 <= ord(c) <= 0xDFFF for c in text):
        return
    assert byte_pairs()()([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_come_back_from_the_pieces(spark):
    df = spark.createDataFrame(TEXTS, "doc_id BIGINT, text STRING").repartition(3)
    rows = pack_texts(df, byte_pairs(), 1, Limits(64, 4, 64)).collect()
    encode = byte_pairs()()
    whole = {d: np.append(encode([(t or "").encode()])[0], 1).astype("<u4") for d, t in TEXTS}
    assert {r.doc_id for r in rows} == set(whole)
    for r in rows:
        ids = whole[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert r.loss_tokens == r.length - (r.start == 0)
    assert sum(r.length for r in rows) == sum(len(whole[d]) for d, _ in TEXTS)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r.segment)
        assert [r.offset for r in members] == [sum(x.length for x in members[:i]) for i in range(len(members))]


def test_examples_with_loss_flags(spark):
    rows = [(1, [1, 2, 3], [False, True, None]), (2, [4], None), (3, [], []), (4, None, None), (5, [5] * 9, [True] * 20)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, ids ARRAY<INT>, loss ARRAY<BOOLEAN>")
    got = pack_tokens(df, Limits(8, 3, 4), loss_col="loss").groupBy("doc_id").sum("length", "loss_tokens").collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(1, 3, 1), (2, 1, 0), (5, 9, 9)}
    assert pack_tokens(df.limit(0)).count() == 0


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id BIGINT, text STRING, start STRING, body STRING, sequence_id STRING"
    assert pack_texts(spark.createDataFrame([], schema), byte_pairs(), 1).count() == 0
    total = pack_texts(spark.createDataFrame([(1, "a", "x", "y", "z")], schema), byte_pairs(), 1).agg({"length": "sum"})
    assert total.first()[0] == 2
