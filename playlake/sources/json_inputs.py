"""Readers for the two JSON folder trees."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.sources.schemas import LOG_SCHEMA, SONG_SCHEMA


def read_song_metadata(spark: SparkSession, base: str) -> DataFrame:
    """Read `<base>/song_data/*/*/*/*.json`, one object per file.

    With millions of files, globbing them one folder after the other on the driver takes longer
    than reading them. So only folders are globbed; Spark lists the files inside in parallel, and
    the filter keeps to the exact depth.
    """
    return _json_at_depth(spark, f"{base.rstrip('/')}/song_data", 3, SONG_SCHEMA)


def read_activity_log(spark: SparkSession, base: str) -> DataFrame:
    """Read `<base>/log_data/*/*/*.json`, one object per line."""
    return _json_at_depth(spark, f"{base.rstrip('/')}/log_data", 2, LOG_SCHEMA)


def _json_at_depth(spark: SparkSession, root: str, folders: int, schema: str) -> DataFrame:
    """JSON files exactly `folders` levels below `root`; Spark prunes other files before it opens them."""
    path = F.regexp_replace("_metadata.file_path", "^[^/]*://[^/]*", "")
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root + "/*" * folders)
        # Files further down differ in depth only, so the depth below the first folders is enough.
        .where(F.size(F.split(path, "/")) == _depth(spark, root) + folders + 1)
    )


def _depth(spark: SparkSession, root: str) -> int:
    """Parts of the absolute path of `root`, without the file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(path.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri().getPath().split("/"))


def is_malformed(df: DataFrame) -> Column:
    """True for a line that could not be parsed: every declared column is NULL."""
    return F.coalesce(*[F.col(c).cast("string") for c in df.columns]).isNull()
