"""Intermediate tables: written once to the folder all executors share, then read back.

A written table cuts the lineage, so a lost executor costs a re-read and not a second scan of
the raw JSON, and every consumer sees the same rows.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Return the path of a folder of its own below a folder that driver and executors share.

    That is the one named by `spark.checkpoint.dir`, and otherwise the warehouse. By default that is a folder of
    the driver's machine: on a cluster it is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not spark.sparkContext.master.startswith("local") and warehouse.startswith("file:"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is not one")
        shared = f"{warehouse}/playlake-scratch"
    return f"{shared.rstrip('/')}/playlake-{uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as Parquet and return the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def file_states(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Name, size and time of change of each file below the given ones."""
    found = []
    for path in paths:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by `scratch_dir`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
