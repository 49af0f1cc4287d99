import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlake.llm.piece_codec import SIDE_BY_SIDE, checked, codec, encode_documents

OWN = codec(public_tokenizers.path("piece_bpe_32k.model"))
ODD = ["", " ", "   a  b ", "\n\n x\n", "▁a ▁▁", "<s> </s> <unk> <0x41>", "é ﬁ 日本 😀\x00\x7f​", "x" * 3000, "ab " * 2000,
       " " * 70, "Donaudampfschifffahrtsgesellschaftskapitän" * 3, "a\tb\r\nc", "\U0010ffff"]


def test_awkward_texts_equal_the_library():
    checked(OWN, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdethinosr  ▁\n.,é😀", max_size=3 * SIDE_BY_SIDE), max_size=8))
def test_any_texts_equal_the_library(texts):
    checked(OWN, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=20))
def test_any_ids_decode_as_in_the_library(ids):
    if 0 not in ids:
        assert OWN.decode(ids) == OWN.library.decode(ids)


def test_heap_and_side_by_side_agree():
    words = ["▁".replace("▁", " ") + w for w in ("hello", "international", "aaaaaaaa", "strengths", "é", "naïve")]
    for word in words:
        assert OWN._spell(OWN._heap(word)) == OWN.encode([word[1:]])[0][:-1]


def test_memory_of_units_turns_over(monkeypatch):
    monkeypatch.setattr("playlake.llm.piece_codec.REMEMBERED", 3)
    for _ in range(3):
        checked(OWN, ["one two three four five", "one six seven eight nine ten"])


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (99, None), (99, None)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id BIGINT, text STRING, ids STRING, body INT")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_documents(df.repartition(3)).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for doc, text in rows:
        ids = OWN.library.encode(text or "", add_eos=True)
        want.add((doc, len(ids), digest(" ".join(map(str, ids))), digest(OWN.library.decode(ids))))
    assert got == want
    assert encode_documents(df.limit(0)).count() == 0


def test_a_difference_stops(monkeypatch):
    monkeypatch.setattr(OWN, "_end", b"\x05\0\0\0")
    with pytest.raises(ValueError, match="library"):
        checked(OWN, ["a"])
