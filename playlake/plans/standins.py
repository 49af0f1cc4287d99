"""Song metadata and activity logs made from general-purpose tables.

Two stars are used. In the linear one each customer is a song and each nation an artist; urgent
orders are the plays, and a play matches exactly one song and artist. In the fan-out one parts are
songs with repeated titles and brands are artists with several rows each; purchase events are
the plays.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions.epoch import epoch_ms_text, start_time
from playlake.operators import dims, fact, reports
from playlake.operators.skew import KeySizes, rows_of, split_join, summarise_counts, unique
from playlake.parallel import together
from playlake.scratch import scratch_dir, stage

# Declared, so that no file has to be opened to plan a query.
COLUMNS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
}

URGENT = "1-URGENT"
PURCHASE = "purchase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def level(status: str) -> Column:
    return F.when(F.col(status) == "F", "paid").when(F.col(status) == "O", "free").otherwise(F.col(status))


class LinearStar:
    """Customers as songs, nations as artists, urgent orders as plays."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.work = scratch_dir(spark)
        self.orders = table(spark, sf_dir, "orders")
        self.customer = table(spark, sf_dir, "customer")
        self.nation = table(spark, sf_dir, "nation")

    @cached_property
    def songs(self) -> DataFrame:
        return stage(dims.songs_dim(self.customer.select(*customer_as_song())), f"{self.work}/songs")

    @cached_property
    def artists(self) -> DataFrame:
        return stage(dims.artists_dim(self.nation.select(*nation_as_artist())), f"{self.work}/artists")

    @cached_property
    def log(self) -> DataFrame:
        """Log lines of the plays, without song and artist."""
        return dims.filter_page(order_log(self.orders), URGENT)

    @cached_property
    def named_customers(self) -> DataFrame:
        """Song and artist name of each customer."""
        return self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_name").alias("song"),
            F.col("n_name").alias("artist"),
        )

    @cached_property
    def plays_per_customer(self) -> DataFrame:
        valid = self.log.withColumn("start_time", start_time("ts")).dropna(subset=["start_time"])
        counted = valid.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("plays"))
        return stage(counted, f"{self.work}/plays_per_customer")

    @cached_property
    def pairs(self) -> DataFrame:
        """Plays per (song, artist), counted per customer before the names are joined."""
        named = self.plays_per_customer.join(self.named_customers, "o_custkey").dropna(subset=fact.PAIR)
        return stage(
            named.groupBy(*fact.PAIR).agg(F.sum("plays").alias("plays")), f"{self.work}/pairs"
        )

    @cached_property
    def matches(self) -> DataFrame:
        together(self.spark, lambda: self.songs, lambda: self.artists, lambda: self.pairs)
        return fact.match_pairs(self.pairs, self.songs, self.artists)

    @cached_property
    def song_plays(self) -> DataFrame:
        """Plays per (artist, song)."""
        return reports.song_plays_of_matches(self.matches)

    @cached_property
    def plays(self) -> DataFrame:
        named = self.add_names(self.log, self.plays_per_customer)
        return named.withColumn("start_time", start_time("ts"))

    @cached_property
    def plays_and_matches(self) -> list[DataFrame]:
        together(self.spark, lambda: self.songs, lambda: self.artists, lambda: self.plays_per_customer)
        return together(self.spark, lambda: self.plays, lambda: stage(self.matches, f"{self.work}/matches"))

    @cached_property
    def fact(self) -> DataFrame:
        plays, matches = self.plays_and_matches
        return fact.build_fact(plays, matches, ["play_no"], self.pairs)

    @cached_property
    def numbered_fact(self) -> DataFrame:
        """The fact with its row ids."""
        plays, matches = self.plays_and_matches
        return fact.build_fact(plays, matches, ["play_no"], self.pairs, "play_no")

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "songs": self.songs,
            "artists": self.artists,
            "users": dims.users_dim(self.log),
            "time": dims.time_dim(self.log),
            "song_plays": self.fact,
        }

    def add_names(self, log: DataFrame, per_customer: DataFrame, number: str = "play_no") -> DataFrame:
        """Give log lines, or the orders they are made of, the song and artist names of their customer."""
        key = ["o_custkey"]
        of_customer = summarise_counts(per_customer, key, "plays")
        sizes = KeySizes(
            of_customer,
            unique(int(of_customer.keys)),
            rows_of(per_customer, key, F.col("plays")),
            rows_of(self.customer.withColumnRenamed("c_custkey", "o_custkey"), key),
            of_customer.rows,
        )
        return split_join(log, self.named_customers, key, [number], ["song"], sizes)

    @cached_property
    def all_lines(self) -> DataFrame:
        """Log lines of all orders, with the folder each belongs to.

        Lines repeat the few columns they are made of, so those are shuffled and sorted, and lines are made at the end.
        """
        day = F.timestamp_millis(epoch_ms_text("o_orderdate").cast("bigint"))
        per_customer = self.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("plays"))
        named = self.add_names(self.orders, per_customer, "o_orderkey")
        dealt = named.withColumns({"y": F.year(day), "m": F.month(day)}).hint("rebalance", F.col("y"), F.col("m"))
        lines = dealt.sortWithinPartitions("y", "m").select("song", "artist", *order_as_line(), "y", "m")
        return lines.select(
            "song", "artist", "userId", "firstName", "lastName", "gender", "level", "location",
            "sessionId", "userAgent",
            F.col("ts").cast("bigint").alias("ts"),
            F.when(F.col("page") == URGENT, "NextSong").otherwise(F.col("page")).alias("page"),
            "y",
            "m",
        )

    def write_inputs(self, base: str) -> None:
        """Write songs and all orders as the two JSON trees the job reads."""
        metadata = self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            *customer_as_song(),
            *nation_as_artist()[1:],
            F.lit(1).alias("num_songs"),
            F.col("n_regionkey").alias("a"),
            F.col("c_mktsegment").alias("b"),
            F.lit("all").alias("c"),
        )
        together(
            self.spark,
            lambda: metadata.write.partitionBy("a", "b", "c").json(f"{base}/song_data"),
            lambda: self.all_lines.write.partitionBy("y", "m").json(f"{base}/log_data"),
        )


def customer_as_song() -> list[Column]:
    return [
        text("c_custkey").alias("song_id"),
        F.col("c_name").alias("title"),
        text("c_nationkey").alias("artist_id"),
        F.col("c_mktsegment").alias("year"),
        text("c_acctbal").alias("duration"),
    ]


def nation_as_artist() -> list[Column]:
    return [
        text("n_nationkey").alias("artist_id"),
        F.col("n_name").alias("artist_name"),
        text("n_regionkey").alias("artist_location"),
        F.lit(None).cast("float").alias("artist_latitude"),
        F.lit(None).cast("float").alias("artist_longitude"),
    ]


def order_log(orders: DataFrame) -> DataFrame:
    """Orders as log lines, without song and artist."""
    return orders.select(*order_as_line())


def order_as_line() -> list[Column]:
    return [
        F.col("o_custkey"),
        F.col("o_orderkey").alias("play_no"),
        epoch_ms_text("o_orderdate").alias("ts"),
        text("o_custkey").alias("userId"),
        F.col("o_orderstatus").alias("firstName"),
        F.concat(F.lit("customer "), text("o_custkey")).alias("lastName"),
        F.col("o_orderstatus").alias("gender"),
        level("o_orderstatus").alias("level"),
        F.col("o_orderstatus").alias("location"),
        F.year("o_orderdate").alias("sessionId"),
        F.col("o_orderpriority").alias("userAgent"),
        F.col("o_orderpriority").alias("page"),
    ]


# Fan-out star


def fanout_metadata(part: DataFrame) -> DataFrame:
    return part.select(
        text("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_id"),
        text("p_size").alias("year"),
        text("p_size").alias("duration"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        F.lit(None).cast("float").alias("artist_latitude"),
        F.lit(None).cast("float").alias("artist_longitude"),
    )


def fanout_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases per (part name, brand), counted per part before the names are joined, and matched."""
    work = scratch_dir(spark)
    part = table(spark, sf_dir, "part")
    events = dims.filter_page(table(spark, sf_dir, "events"), PURCHASE, "event_type")
    key = F.from_json("props", "k BIGINT")["k"].alias("p_partkey")
    counted = events.select(key).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("plays"))
    named = counted.join(part, "p_partkey").select(
        F.col("p_name").alias("song"), F.col("p_brand").alias("artist"), "plays"
    )
    pairs = named.groupBy(*fact.PAIR).agg(F.sum("plays").alias("plays"))
    metadata = fanout_metadata(part)
    songs, artists, pairs = together(
        spark,
        lambda: stage(dims.songs_dim(metadata), f"{work}/songs"),
        lambda: stage(dims.artists_dim(metadata), f"{work}/artists"),
        lambda: stage(pairs, f"{work}/pairs"),
    )
    return fact.match_pairs(pairs, songs, artists)


# Activity log


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("*", epoch_ms_text("ts").alias("ms")).select(
        F.col("ms").alias("ts"), text("user_id").alias("userId"), F.col("event_type").alias("page")
    )
