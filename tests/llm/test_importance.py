import numpy as np

from playlake.llm import importance
from playlake.llm.importance import features, kth_largest, log_ratio, resample, target_sample

GOOD = "The quiet river runs past the old mill and on to the sea."
BAD = "BUY!!! now$$$ %%% ### CLICK!!! here$$$"
SCHEMA = "doc_id BIGINT, text STRING"


def rows():
    out = [(i, f"{GOOD} " * 20 + f"Part {i} of it.") for i in range(60)] + [(100 + i, f"{BAD} " * 20 + f"{i}!!!") for i in range(20)]
    return out + [(200, None), (201, ""), (None, GOOD), (202, GOOD), (202, GOOD), (203, "word " * 30_000)]


def test_draw_equals_the_same_sums_by_hand(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id BIGINT")
    got = resample(df, target).collect()
    counts = [np.bincount(features((t or "").encode()), minlength=importance.BUCKETS) for _, t in rows()]
    ratio = log_ratio(sum(c for c, (d, _) in zip(counts, rows()) if d in range(0, 60, 2)), sum(counts))
    weights = {(d, t): float((c * ratio).sum()) for c, (d, t) in zip(counts, rows())}
    assert len(got) == len(rows())
    for r in got:
        assert abs(r.log_weight - weights[r.document.doc_id, r.document.text]) < 1e-6
    keep = sum(w > -np.log(importance.REJECT_ODDS) for d, w in [(d, weights[d, t]) for d, t in rows()])
    least = sorted([r.sample_key for r in got], reverse=True)[keep - 1]
    assert all(r.kept == (r.sample_key >= least) for r in got)
    assert all(r.kept for r in got if r.document.doc_id in range(60))
    assert not any(r.kept for r in got if r.document.doc_id in range(100, 120))
    assert {r.log_weight for r in got if r.document.doc_id in (200, 201)} == {0.0}


def test_a_given_number_is_drawn_at_any_temperature(spark):
    df = spark.createDataFrame([(i, GOOD) for i in range(500)], SCHEMA)
    none = spark.createDataFrame([], "doc_id BIGINT")
    drawn = resample(df, none, keep=100, temperature=1.0).where("kept").select("document.doc_id").collect()
    assert len(drawn) == 100
    again = resample(df.repartition(5), none, keep=100, temperature=1.0).where("kept").select("document.doc_id").collect()
    assert sorted(drawn) == sorted(again)
    assert 20 < sum(r.doc_id < 250 for r in drawn) < 80


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(3).normal(size=3000).round(2)] + [1e300, -1e300, 5.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for k in (1, 2, 3, 500, 1500, 3003, 3004):
        assert kth_largest(df, "x", k, bins=7) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "x", 3005) == float("-inf") and kth_largest(df, "x", 0) == float("inf")
    assert kth_largest(df.limit(0), "x", 1) == float("-inf")


def test_target_sample_and_empty_and_clashing(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id BIGINT, quality INT")
    good = target_sample(labels, "doc_id", labels.quality == 1, 10)
    assert sorted(r.doc_id for r in good.collect()) == [1, 3]
    assert target_sample(labels, "doc_id", labels.quality == 1, 1).count() == 1
    schema = SCHEMA + ", target STRING, weight STRING, document STRING, kept STRING"
    df = spark.createDataFrame([(1, GOOD, "a", "b", "c", "d")], schema)
    assert resample(df, good).first().document.asDict() == df.first().asDict()
    assert resample(df.limit(0), good).count() == 0


def test_labels_of_the_tables_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fitted = target_sample(labels.where("doc_id % 2 = 0"), "doc_id", labels.quality == 1, 1000)
    drawn = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), fitted, carry=["doc_id"])
    held = drawn.select("document.doc_id", "kept").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in held) / len(held) > 0.97
