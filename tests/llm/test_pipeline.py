import pytest

import corpus_pipeline
from playlake.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect_and_return_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts, changed = docs.dtypes, [docs.count()], []
    for name, function in corpus_pipeline.STAGES[:-1]:
        function(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.dtypes == columns
        counts.append(after.count())
        changed.append(after.join(docs, ["doc_id", "text"], "left_anti").count())
        docs = after
    assert counts[0] > counts[1] >= counts[2] > 0 and changed[0] == 0 and changed[1] > 0 and changed[2] == 0
    assert docs.where("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    whole = corpus_pipeline.run(spark, SF_DIR)
    order = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(whole.select(*order).groupBy("doc_id").sum("length").collect()) == sorted(
        pieces.select(*order).groupBy("doc_id").sum("length").collect()
    )


def test_near_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text, "en", "s", 1), (2, text + " end", "en", "s", 1), (3, "other words", "en", "s", 1), (None, "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    assert sorted((r.doc_id for r in corpus_pipeline.near(spark, docs, SF_DIR).collect()), key=str) == [1, 3, None]


def test_near_stage_keeps_one_of_repeated_rows_and_of_copies_without_an_id(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(100)) for c in "wv")
    rows = [(1, text), (1, text), (None, text + " end"), (None, other), (None, other), (None, other + " end"), (4, "x"), (4, "x"), (None, "y")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    got = corpus_pipeline.near(spark, docs, SF_DIR)
    assert got.dtypes == docs.dtypes
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted((i, t[:1]) for i, t in left if i) == [(1, "w"), (4, "x")]
    assert sorted(t[:1] for i, t in left if not i) == ["v", "y"]


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_queries_equal_their_oracles(spark, name):
    import duckdb

    found = LLM_QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = found.select(*columns).collect()
    assert rows
    if name in LLM_ORACLES:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "conversations", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLES[name]})").fetchall()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
