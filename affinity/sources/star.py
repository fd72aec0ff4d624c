"""The star-schema test tables seen as ratings, products, users and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.scalars import epoch_seconds
from affinity.schemas import RATING_MARKER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line: the customer rates the part by quantity."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = lines.select(
        "l_orderkey", F.col("l_partkey").alias("product_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        epoch_seconds(lines, "l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"))
    users = orders.select(F.col("o_orderkey").alias("l_orderkey"),
                          F.col("o_custkey").alias("user_id"))
    return rows.join(users, "l_orderkey").select(
        "user_id", "product_id", "score", "ts", "event_id")


def events_as_ratings(events: DataFrame, *keep: str) -> DataFrame:
    """One rating per event: product from the properties, score from the value."""
    return events.select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.least(F.lit(5), F.greatest(F.lit(1), F.ceil(F.col("value") / 20)))
        .cast("double").alias("score"),
        epoch_seconds(events, "ts").alias("ts"), "event_id", *keep)


def ratings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_ratings(table(spark, sf_dir, "events"))


def events_as_log(events: DataFrame) -> DataFrame:
    """Events as tracking-log lines.

    Purchases carry the rating marker, errors carry it with a broken product
    field, all others are ordinary lines without it.
    """
    rows = events_as_ratings(events, "event_type")
    header = F.concat(F.lit("INFO [http] event "), F.col("event_id").cast("string"), F.lit(" "))
    marker = F.lit(RATING_MARKER)
    good = F.concat_ws("|", "user_id", "product_id", "score", "ts")
    broken = F.concat_ws("|", F.col("user_id"), F.lit("x"), F.col("score"), F.col("ts"))
    body = (F.when(F.col("event_type") == "purchase", F.concat(marker, good))
            .when(F.col("event_type") == "error", F.concat(marker, broken))
            .otherwise(F.concat(F.lit("page "), F.col("event_type"))))
    return rows.select("event_id", F.concat(header, body).alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_log(table(spark, sf_dir, "events"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; the tags are the name's words, the brand and the type."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.concat(F.lit("/img/"), F.col("p_partkey").cast("string"), F.lit(".jpg"))
        .alias("image_url"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", F.translate("p_name", " ", "|"), "p_brand", "p_type").alias("tags"))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as user registrations, in the order of their keys."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"), F.col("c_custkey").alias("ts"))


def rating_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ten-star ratings submitted under the customer's name."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("user_id").alias("c_custkey"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.least(F.lit(10), F.greatest(F.lit(1), F.ceil(F.col("value") / 10)))
        .cast("double").alias("score"),
        epoch_seconds(events, "ts").alias("ts"), "event_id")
    names = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("username"))
    return rows.join(names, "c_custkey").drop("c_custkey")


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
