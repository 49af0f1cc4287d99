import pytest

from playlake import scratch


class Session:
    """Just enough of a session to ask for a folder."""

    def __init__(self, master, shared=None, checkpoints=None, warehouse="w"):
        self.conf = {"spark.sql.warehouse.dir": warehouse}
        if shared:
            self.conf["spark.checkpoint.dir"] = shared
        self.sparkContext = type(
            "Context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: checkpoints)}
        )


def test_shared_folder_of_the_session_is_used(spark):
    path = scratch.scratch_dir(spark)
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch.scratch_dir(spark)


def test_order_of_preference():
    assert scratch.scratch_dir(Session("yarn", "s3a://b/shared/", "/c")).startswith("s3a://b/shared/playlake-")
    assert scratch.scratch_dir(Session("yarn", None, "hdfs:///c")).startswith("hdfs:///c/playlake-")


def test_without_a_setting_the_warehouse_is_used_and_no_machine_local_folder():
    path = scratch.scratch_dir(Session("yarn", warehouse="hdfs:///warehouse/"))
    assert path.startswith("hdfs:///warehouse/playlake-scratch/playlake-")


def test_a_machine_local_warehouse_is_refused_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Session("yarn", warehouse="file:/home/me/spark-warehouse"))
    assert scratch.scratch_dir(Session("local[4]", warehouse="file:/w")).startswith("file:/w/playlake-scratch/")


def test_stage_keeps_rows_and_types_and_discard_deletes(spark):
    folder = scratch.scratch_dir(spark)
    df = spark.sql("SELECT 'a' AS s, CAST(NULL AS FLOAT) AS f, TIMESTAMP '2018-11-01 00:00:00' AS t")
    staged = scratch.stage(df, f"{folder}/x")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert staged.collect() == df.collect()
    scratch.discard(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/x")
