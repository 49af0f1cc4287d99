"""Writers: how folders are dealt to tasks, outputs that are replaced whole or not at all, registered folders."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from playlake import catalog, sinks
from playlake.catalog import add_partitions, drop_tables, register_tables
from playlake.operators import audit
from playlake.plans.job import SUMS_SCHEMA
from playlake.publish import publish, recover


def per_task(df, columns):
    folders = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    dealt = sinks.deal(df, folders, columns).withColumn("task", F.spark_partition_id())
    assert dealt.drop("task").exceptAll(df).isEmpty() and dealt.count() == df.count()
    return dealt.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*columns).alias("folders")).collect()


@pytest.mark.parametrize("folders, each", [(60, 900), (200, 130), (3, 9000), (1000, 3)])
def test_no_task_writes_more_than_twice_the_rows(spark, monkeypatch, folders, each):
    """Folders just below the rows of a task never meet in one, as they would by a hash."""
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 1000)
    df = spark.range(folders * each).selectExpr(f"id % {folders} AS folder", "id")
    tasks = per_task(df, ["folder"])
    assert max(t["n"] for t in tasks) <= 2000
    assert max(t["folders"] for t in tasks) <= 2 * sinks.FOLDERS_PER_TASK


def test_one_huge_folder_beside_small_ones(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 1000)
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, NULL, CAST(id % 400 AS STRING)) AS folder", "id AS __x", "id")
    tasks = per_task(df, ["folder"])
    assert max(t["n"] for t in tasks) <= 2000 and len(tasks) >= 20


def test_nothing_to_deal(spark, tmp_path):
    df = spark.createDataFrame([], "folder STRING, id BIGINT")
    assert sinks.write_partitioned(df, f"{tmp_path}/out", ["folder"]).rows == 0
    assert spark.read.schema(df.schema).parquet(f"{tmp_path}/out").count() == 0


WRITERS = {
    "table": lambda df, path: sinks.write_table(df, path),
    "partitioned": lambda df, path: sinks.write_partitioned(df, path, ["folder"]),
    "csv": lambda df, path: sinks.write_csv(df, path, header=True),
}


@pytest.mark.parametrize("writer", WRITERS)
def test_a_write_that_fails_leaves_the_last_output(spark, tmp_path, writer):
    path = f"{tmp_path}/out"
    good = spark.range(20).selectExpr("id", "id % 3 AS folder")
    bad = spark.range(20).selectExpr("IF(id = 17, raise_error('broken row'), id) AS id", "id % 3 AS folder")
    read = spark.read.option("header", True).csv if writer == "csv" else spark.read.parquet
    assert WRITERS[writer](good, path).rows == 20
    with pytest.raises(Exception, match="broken row"):
        WRITERS[writer](bad, path)
    assert {int(r["id"]) for r in read(path).collect()} == set(range(20))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    assert WRITERS[writer](good.where("id < 5"), path).rows == 5
    assert {int(r["id"]) for r in read(path).collect()} == set(range(5))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def fill(text):
    def write(folder):
        Path(folder).mkdir()
        (Path(folder) / "data").write_text(text)

    return write


@pytest.mark.parametrize("stopped_after", ["mark", "first rename", "second rename"])
def test_a_change_of_places_that_was_cut_short_is_finished(spark, tmp_path, stopped_after):
    path = tmp_path / "out"
    publish(spark, str(path), fill("first"))
    new, old = tmp_path / ".out.1.new", tmp_path / ".out.1.old"
    fill("second")(new)
    (tmp_path / ".out.publishing").write_text(f"{new.name}\n{old.name}")
    if stopped_after != "mark":
        path.rename(old)
    if stopped_after == "second rename":
        new.rename(path)
    recover(spark, str(path))
    assert (path / "data").read_text() == "second"
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    publish(spark, str(path), fill("third"))
    assert (path / "data").read_text() == "third"


def test_a_folder_without_a_marker_is_left_alone(spark, tmp_path):
    """It may be of a run that is still writing."""
    fill("other")(tmp_path / ".out.2.new")
    publish(spark, f"{tmp_path}/out", fill("mine"))
    assert sorted(p.name for p in tmp_path.iterdir()) == [".out.2.new", "out"]


def test_thousands_of_folders_are_registered_without_listing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "PARTITIONS_AT_A_TIME", 700)
    path, folders = f"{tmp_path}/songs", 5000
    df = spark.range(folders).selectExpr("CAST(id % 50 AS STRING) AS year", "CONCAT('a', id) AS artist_id", "1 AS n")
    (Path(path) / sinks.FOLDER_LIST).parent.mkdir()
    df.write.parquet(f"{path}/{sinks.FOLDER_LIST}")
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, **more: said.append(text) or sql(self, text, **more))
    names = register_tables(spark, {"songs": path}, prefix="many_")
    try:
        assert spark.sql("SHOW PARTITIONS many_songs").count() == folders
    finally:
        drop_tables(spark, names)
    assert not any("MSCK" in text or "RECOVER" in text for text in said)
    assert sum("ADD IF NOT EXISTS" in text for text in said) == -(-folders // 700)


def test_registered_folders_with_awkward_names(spark, tmp_path):
    values = ["plain", "it's", "a/b", "x=y", "back\\slash", 'quo"te', "", None, "%41", "ünï", " "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, folder STRING")
    sinks.write_partitioned(df, f"{tmp_path}/out", ["folder"])
    spark.sql(f"CREATE TABLE awkward (id INT, folder STRING) USING parquet PARTITIONED BY (folder) LOCATION '{tmp_path}/out'")
    try:
        add_partitions(spark, "awkward", f"{tmp_path}/out", ["folder"])
        found = {r["id"]: r["folder"] for r in spark.sql("SELECT * FROM awkward").collect()}
    finally:
        drop_tables(spark, ["awkward"])
    assert found == {i: v or None for i, v in enumerate(values)}


def test_checksums_see_what_counts_do_not(spark, tmp_path):
    """One value that is altered after the write, or two rows that change places between columns."""
    rows = [(1, "a", None, "2018"), (2, None, "b", ""), (2, None, "b", ""), (3, "c", "d", None)]
    schema = "id INT, x STRING, y STRING, year STRING"
    df = spark.createDataFrame(rows, schema)
    written = sinks.write_partitioned(df, f"{tmp_path}/songs", ["year"])
    again = spark.read.schema(schema).parquet(f"{tmp_path}/songs")
    label = audit.LABELS["songs"]
    recorded = spark.createDataFrame([(label, written.rows, written.checksum)], SUMS_SCHEMA)

    def status(frame):
        return audit.reconcile_counts(recorded, audit.table_sums({"songs": frame}, {"songs": ["year"]})).first()["status"]

    assert status(again) == "ok"
    assert status(again.select("year", "y", "x", "id").repartition(3)) == "ok"
    altered = [
        again.withColumn("id", F.when(F.col("id") == 3, 4).otherwise(F.col("id"))),
        again.withColumn("y", F.when(F.col("id") == 1, "a").otherwise(F.col("y"))).withColumn(
            "x", F.when(F.col("id") == 1, None).otherwise(F.col("x"))),
        again.where("id <> 2").unionAll(again.where("id = 1")).unionAll(again.where("id = 3")),
        again.withColumn("year", F.lit("2018")),
    ]
    assert {status(frame) for frame in altered} == {"mismatch"}
    assert {frame.count() for frame in altered} == {4}


def test_row_ids_of_a_plain_table_take_little_space(spark, tmp_path):
    sinks.write_table(spark.range(500_000).repartition(1), f"{tmp_path}/ids")
    assert sum(f.stat().st_size for f in Path(tmp_path, "ids").glob("*.parquet")) < 3 * 500_000
