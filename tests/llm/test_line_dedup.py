import random

import pytest

from playlake.llm.line_dedup import MAX_LINES, MIN_LINES, PASSAGE_WORDS, line_chunks, line_dedup, without_chunks

PASSAGE = "\n".join(f"shared line number {i} with some words" for i in range(12))
TEXTS = [
    (5, f"five\nown words here\n{PASSAGE}\nend of five"),
    (2, f"two\n{PASSAGE}"),
    (3, f"{PASSAGE}\n{PASSAGE}\n"),
    (None, f"no id\n{PASSAGE}\ntail"),
    (6, None), (7, ""), (8, "\n\n\n\n"), (9, "\n\n\n\n"), (10, "one line"), (11, "one line"),
    (12, "a\r\nb\r\nc\r\nd"), (13, "a\r\nb\r\nc\r\nd"), (14, "\n".join("x" * 3 for _ in range(500))),
    (16, "word " * 60 + "\nx"), (17, "y\n" + "word " * 60 + "\n\n \nz"), (18, "a\n\n b\n\nc"), (19, "\na\n\n b\n\nc\n"),
    (15, "same row\nof two lines\nand three"), (15, "same row\nof two lines\nand three"),
]
SCHEMA = "doc_id BIGINT, text STRING"


def without(text, covered):
    """Line by line: what is blank after a line goes with it."""
    out, full, gone = [], -1, False
    for line in text.split("\n"):
        if line.strip():
            full += 1
            gone = full in covered
        out.append(None if gone else line)
    return "".join(kept + "\n" for kept in out[:-1] if kept is not None) + (out[-1] or "")


def expected(rows):
    """By place order of ids; rows with equal id and text are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for row in order:
        for place, _, chunk in line_chunks((row[1] or "").encode()):
            first.setdefault(chunk, (row, place))
    out = []
    for row in rows:
        again = [(p, n) for p, n, c in line_chunks((row[1] or "").encode()) if first[c] != (row, p)]
        covered = {i for p, n in again for i in range(p, p + n)}
        out.append((row[0], without(row[1], covered) if again else row[1], len(again)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_bits", [64, 1])
def test_equals_brute_force_also_when_chunks_share_hashes(spark, hash_bits):
    rows = line_dedup(spark.createDataFrame(TEXTS, SCHEMA), hash_bits=hash_bits).collect()
    got = sorted([(r.document.doc_id, r.text, r.removed_chunks) for r in rows], key=str)
    assert got == expected(TEXTS)
    assert sum(n for _, _, n in got) > 8


def test_chunks_are_of_the_text_and_keep_their_sizes():
    for _, text in TEXTS:
        for place, size, chunk in line_chunks((text or "").encode()):
            assert chunk in text.encode() and size == sum(1 for line in chunk.split(b"\n") if line.strip())
            assert MIN_LINES <= size <= MAX_LINES or size == 1 and len(chunk.split()) > PASSAGE_WORDS


def test_every_passage_of_over_fifty_words_that_repeats_is_found(spark):
    rng = random.Random(5)

    def line(words):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))

    rows, passages = [], []
    for i in range(150):
        lines = rng.randint(1, 6)
        passage = "\n".join(line(60 // lines + rng.randint(1, 9)) for _ in range(lines))
        passages.append(passage)
        for copy in range(3):
            parts = [line(7) for _ in range(rng.randint(0, 4))] + [passage] + [line(9) for _ in range(rng.randint(0, 4))]
            rows.append((3 * i + copy, "\n".join(parts)))
    got = {r.document.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, passage in enumerate(passages):
        assert passage in got[3 * i] and got[3 * i] == rows[3 * i][1]
        for copy in (1, 2):
            own = [x for x in rows[3 * i + copy][1].split("\n") if x not in passage.split("\n")]
            left = [x for x in got[3 * i + copy].split("\n") if x in passage.split("\n")]
            # Found, own lines kept, and of the passage at most its end is left, if no cut falls there.
            assert len(left) < len(passage.split("\n")) and all(x in got[3 * i + copy].split("\n") for x in own)
            assert sum(len(x.split()) for x in left) <= PASSAGE_WORDS


def test_a_passage_is_cut_alike_wherever_it_stands():
    inside = [{c for *_, c in line_chunks(f"{before}{PASSAGE}\n{after}".encode())} for before, after in
              [("", ""), ("x\n", "y"), ("x\ny z\nq\n", "a\nb"), ("1\n2\n3\n4\n5\n", "")]]
    assert len(set.intersection(*inside)) >= 2


def test_columns_pass_through_and_empty_table(spark):
    schema = SCHEMA + ", document STRING, places INT, removed_chunks DOUBLE, `odd.name` STRING"
    df = spark.createDataFrame([(1, "a\nb", "d", 4, 2.0, "o")], schema)
    row = line_dedup(df).first()
    assert row.document.asDict() == df.first().asDict() and row.text == "a\nb" and row.removed_chunks == 0
    assert line_dedup(df.limit(0)).count() == 0


def test_passages_inside_lines_go_and_what_stands_around_them_stays(spark):
    rng = random.Random(6)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def sentences(n):
        return " ".join(" ".join(words(rng.randint(4, 15))).capitalize() + rng.choice(".!?") for _ in range(n))

    rows, passages, own = [], [], []
    for i in range(100):
        passage = sentences(2)
        while len(passage.split()) <= PASSAGE_WORDS:
            passage += rng.choice(" \n") + sentences(1)
        passages.append(passage)
        for copy in range(3):
            # After a full stop, or inside a sentence.
            before = sentences(2) + ["", " own " + " ".join(words(3))][i % 2]
            after = " ".join(words(5)) + ". " + sentences(1)
            own.append((before, after))
            rows.append((3 * i + copy, f"{before} {passage} {after}\n{sentences(1)}"))
    got = {r.document.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    stays = 0
    for doc, text in rows:
        if doc % 3 == 0:
            assert got[doc] == text
            continue
        before, after = own[doc]
        assert got[doc].startswith((before + " ", before + "\n")) and after + "\n" in got[doc] and got[doc].endswith(text.split("\n")[-1])
        # Of the passage at most the end is left.
        left = got[doc][len(before) : got[doc].index(after)].split()
        assert len(left) < len(passages[doc // 3].split()) and left == passages[doc // 3].split()[-len(left) :] * bool(left)
        assert len(left) <= PASSAGE_WORDS
        stays += len(left)
    assert stays < 0.15 * 2 * sum(len(p.split()) for p in passages)


def test_short_sentences_that_repeat_stay(spark):
    rows = [(i, f"Text number {i}. Yes. No. It is so. And text {i} ends.") for i in range(20)]
    got = line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.document.doc_id, r.text) for r in got) == rows


def test_the_line_feed_stays_with_what_is_left_of_its_line():
    passage = "Far too many " + "words " * PASSAGE_WORDS + "here."
    body = f"Own one. {passage}  \n\nNext. {passage} Last.\n {passage}\nEnd".encode()
    gone = {place for place, _, chunk in line_chunks(body) if chunk == passage.encode()}
    assert len(gone) == 3 and next(without_chunks([body], [list(gone)])) == b"Own one.  \n\nNext. Last.\nEnd"
