"""Popularity and average-score statistics over ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.scalars import year_month
from affinity.session import cut_lineage


def product_counts(ratings: DataFrame) -> DataFrame:
    """Rating rows per product. One shuffle, combined on the map side."""
    return ratings.groupBy("product_id").agg(F.count("product_id").alias("count"))


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """Products by number of ratings, most first."""
    return product_counts(ratings).orderBy(F.desc("count"), "product_id")


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """Ratings per product and month, newest month first, most first."""
    monthly = (ratings.select("product_id", year_month(F.col("ts")).alias("yearmonth"))
               .groupBy("yearmonth", "product_id").agg(F.count("product_id").alias("count")))
    return (monthly.select("product_id", "count", "yearmonth")
            .orderBy(F.desc("yearmonth"), F.desc("count"), "product_id"))


def average_scores(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("product_id").agg(F.avg("score").alias("avg"))


def average_products(ratings: DataFrame) -> DataFrame:
    """Mean score per product, lowest first."""
    return average_scores(ratings).orderBy("avg", "product_id")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("product_id").distinct()


def rating_triple(ratings: DataFrame) -> DataFrame:
    """The training projection: no time, no event id."""
    return ratings.select("user_id", "product_id", "score")


def attach_product_counts(ratings: DataFrame) -> DataFrame:
    """Each rating with the number of ratings of its product."""
    return ratings.join(cut_lineage(product_counts(ratings)), "product_id")
