"""Ranked product feeds with details, for many keys at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.scalars import recode_latin1_utf8, score_normalize
from affinity.operators.search import matching
from affinity.operators.topk import flatten_lists, recent_ratings_queue, topk_per_key
from affinity.operators.upserts import ratings_upsert, resolve_users
from affinity.schemas import LIST_SIZE, RATING_MARKER


def product_details(products: DataFrame, averages: DataFrame) -> DataFrame:
    """Products with their average score, 0 where nobody has rated them."""
    return (products.join(averages.select("product_id", F.col("avg").alias("avg_score")),
                          "product_id", "left")
            .withColumn("avg_score", F.coalesce("avg_score", F.lit(0.0))))


def enrich_products(recs: DataFrame, details: DataFrame) -> DataFrame:
    """Recommendation rows with product details; unknown products give no row.

    For many rows ``details`` should be a written table of ``product_details``, so
    that a product in a third of all lists is split over tasks.
    """
    return recs.join(details, "product_id")


def _head(table: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in order, a product kept at its best rank only."""
    top = table.orderBy(*order).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return (ranked.groupBy("product_id").agg(F.min("rank").alias("rank"))
            .withColumn("score", F.lit(0.0)))


def hot_products_feed(recently: DataFrame, details: DataFrame, n: int = LIST_SIZE) -> DataFrame:
    """Most rated products of the newest months."""
    order = [F.desc("yearmonth"), F.desc("count"), F.asc("product_id")]
    return enrich_products(_head(recently, order, n), details)


def top_rated_feed(counts: DataFrame, details: DataFrame, n: int = LIST_SIZE) -> DataFrame:
    """Most rated products of all time."""
    return enrich_products(_head(counts, [F.desc("count"), F.asc("product_id")], n), details)


def lists_for_products(ids: DataFrame, lists: DataFrame, details: DataFrame,
                       n: int | None = None) -> DataFrame:
    """Stored lists of the wanted products, enriched: ``ids`` has ``product_id``."""
    wanted = lists.join(ids.select("product_id").distinct(), "product_id", "left_semi")
    flat = flatten_lists(wanted.withColumnRenamed("product_id", "for_product"), "for_product", k=n)
    return enrich_products(flat, details)


def lists_for_users(usernames: DataFrame, users: DataFrame, lists: DataFrame,
                    details: DataFrame, n: int = LIST_SIZE) -> DataFrame:
    """Stored lists of the named users, enriched: ``usernames`` has ``username``."""
    ids = resolve_users(usernames.select("username").distinct(), users)
    flat = flatten_lists(lists.join(ids, "user_id"), "username", k=n)
    return enrich_products(flat, details)


def product_info(ids: DataFrame, products: DataFrame, averages: DataFrame) -> DataFrame:
    return product_details(product_in_list(products, ids), averages)


def product_search(products: DataFrame, averages: DataFrame, pattern: str,
                   mojibake: bool = False, index: DataFrame | None = None) -> DataFrame:
    """Products whose name matches a pattern anywhere, case-sensitively.

    With ``mojibake`` the pattern's UTF-8 bytes are taken to have been read as Latin-1. With a
    written ``name_index`` only the names that have the pattern's trigrams are read.
    """
    if index is not None:
        if mojibake:
            pattern = pattern.encode("latin-1", "replace").decode("utf-8", "replace")
        return product_details(matching(products, index, pattern), averages)
    wanted = recode_latin1_utf8(F.lit(pattern)) if mojibake else F.lit(pattern)
    return product_details(products.where(F.regexp_like("name", wanted)), averages)


def product_in_list(products: DataFrame, ids: DataFrame) -> DataFrame:
    return products.join(ids.select("product_id").distinct(), "product_id", "left_semi")


def lookup_by_key(table: DataFrame, keys: DataFrame, key: str, first_by: list | None = None
                  ) -> DataFrame:
    """Rows of many keys at once; the first row of a key where an order is given.

    The first rows are found before the join, where a hot key costs a row per task.
    """
    rows = table if first_by is None else topk_per_key(table, key, first_by, 1).drop("rank")
    return rows.join(keys.select(key).distinct(), key, "left_semi")


def rating_intake(requests: DataFrame, users: DataFrame, base: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Submitted ten-star scores to stored ratings, recent queue and log payloads."""
    known = resolve_users(requests, users).select(
        "user_id", "product_id", score_normalize(F.col("score")).alias("score"), "ts", "event_id")
    payload = F.concat_ws("|", "user_id", "product_id", "score", "ts")
    lines = known.select("event_id", F.concat(F.lit(RATING_MARKER), payload).alias("value"))
    return ratings_upsert(base, known), recent_ratings_queue(known), lines
