"""Top-k per key, ranked lists, and the recent-ratings queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.schemas import QUEUE_SIZE, RECENT_SIZE


def topk_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column],
                 k: int | None, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key in a total order, with their rank.

    Catalyst turns the filter into a group limit ahead of the shuffle, so a
    key that holds much of the data sends at most ``k`` rows per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked if k is None else ranked.where(F.col(rank) <= k)


def topk_to_depth(df: DataFrame, key: str, cell: str, order: Sequence[Column], depth: str,
                  rank: str = "rank") -> DataFrame:
    """The first rows of every key, as many as its own column ``depth`` says, with their rank.

    A key's rows are first ranked within its cells, so that a key with very many of them is the work
    of several tasks; where ``df`` is dealt out by key and cell already, that takes no shuffle.
    The rows that a cell passes on are ``depth`` at most, whatever other keys ask for.
    """
    kept = df
    for keys in ([key, cell], [key]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = kept.withColumn(rank, place).where(F.col(rank) <= F.col(depth))
    return kept


def ranked_lists(flat: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Flat ``(key, rank, product_id, score)`` rows to one nested list per key.

    All rows are kept unless ``k`` is given; a list is one value, so its rows should be bounded.
    """
    kept = flat if k is None else flat.where(F.col("rank") <= k)
    packed = kept.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("rank", "product_id", "score"))).alias("packed"))
    return packed.select(key, F.transform(
        "packed", lambda r: F.struct(r["product_id"].alias("product_id"),
                                     r["score"].alias("score"))).alias("recs"))


def flatten_lists(lists: DataFrame, key: str, product: str = "product_id",
                  k: int | None = None) -> DataFrame:
    """One nested list per key back to flat rows with their rank."""
    recs = F.col("recs") if k is None else F.slice("recs", 1, k)
    return (lists.select(F.col(key), F.posexplode(recs).alias("pos", "rec"))
            .select(key, (F.col("pos") + 1).alias("rank"),
                    F.col("rec.product_id").alias(product), F.col("rec.score").alias("score")))


_NEWEST = ("ts", "event_id", "score", "product_id")


def newest_first() -> list[Column]:
    return [F.desc(c) for c in _NEWEST]


def recent_ratings_queue(ratings: DataFrame, size: int = QUEUE_SIZE) -> DataFrame:
    """The newest ``size`` ratings of every user, newest first."""
    return (topk_per_key(ratings.select("user_id", "product_id", "score", "ts", "event_id"),
                         "user_id", newest_first(), size)
            .select("user_id", "rank", "product_id", "score", "ts", "event_id"))


def recent_ratings_topn(ratings: DataFrame, n: int = RECENT_SIZE) -> DataFrame:
    """What the re-scorer reads: both ends of the range 0..20 are included."""
    return recent_ratings_queue(ratings, n)
