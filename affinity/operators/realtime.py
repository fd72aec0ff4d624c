"""Re-scoring of a user's candidates from the newest ratings, set at a time."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.itemcf import lists_to_depth, user_items
from affinity.operators.topk import recent_ratings_topn, topk_per_key
from affinity.schemas import LIKE_ABOVE, LIST_SIZE, SIM_THRESHOLD

#: Pairs of candidate and recent rating in a part: for each rating so many, and at least so many in all.
PART_PAIRS, LEAST_PART = 2, 25_000_000


def not_yet_rated(candidates: DataFrame, rated: DataFrame) -> DataFrame:
    """Candidates without those the user has rated."""
    return candidates.join(rated.select("user_id", "product_id"), ["user_id", "product_id"],
                           "left_anti")


def realtime_inputs(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every user's recent ratings, and all products they have rated.

    Both are compact and read by several joins: write or persist them first.
    """
    return recent_ratings_topn(ratings), ratings.select("user_id", "product_id").distinct()


def newest_rating(recent: DataFrame) -> DataFrame:
    """The event that triggers a user's list."""
    return recent.where("rank = 1").drop("rank")


def ranked_sims(sims: DataFrame) -> DataFrame:
    """``product_id, rec_id, sim`` with each row's ``place`` in its product's list.

    Write it before use: it is read for candidates and again for scores.
    """
    alike = F.round(F.col("sim"), 9)
    return topk_per_key(sims.select("product_id", "rec_id", "sim"), "product_id",
                        [F.desc(alike), F.asc("rec_id")], None, "place")


def list_depths(current: DataFrame, rated: DataFrame, n: int = LIST_SIZE) -> DataFrame:
    """``product_id, depth``: how deep the lists of the just rated products are read.

    Among the first n + r of a list are n that a user with r rated products has not rated.
    """
    reach = rated.groupBy("user_id").agg((F.count("*") + n).alias("reach"))
    return (current.join(reach, "user_id", "left").groupBy("product_id")
            .agg(F.max(F.coalesce("reach", F.lit(n))).alias("depth")))


def deep_lists(ratings: DataFrame, depths: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """What ``ranked_sims`` gives, as deep as ``depths`` asks for and for its products only.

    ``depths`` is a written table; so is ``rows``, the ``user_items`` of the ratings where these are
    at hand. Every list has its own depth, and pairs of other products are not formed.
    """
    return lists_to_depth(user_items(ratings) if rows is None else rows, depths).select(
        "product_id", "rec_id", "sim", F.col("rank").alias("place"))


def scoring_keys(candidates: DataFrame, recent: DataFrame) -> DataFrame:
    """``product_id, rec_id``: the pairs of candidate and recently rated product, once for every user and rating."""
    return (candidates.select("user_id", "product_id")
            .join(recent.select("user_id", F.col("product_id").alias("rec_id")), "user_id")
            .where("product_id <> rec_id").select("product_id", "rec_id"))


def candidate_parts(candidates: DataFrame, recent: DataFrame, rows: DataFrame) -> list[DataFrame]:
    """The candidates in parts by product, each with a bounded number of pairs to score per rating.

    All are written tables. Who writes the scores of a part before the next needs disk for the pairs of one.
    """
    mine = recent.groupBy("user_id").agg(F.count("*").alias("seen"))
    pairs = candidates.join(mine, "user_id").agg(F.sum("seen")).first()[0] or 0
    parts = max(1, math.ceil(pairs / max(LEAST_PART, PART_PAIRS * rows.count())))
    part = F.pmod(F.xxhash64("product_id", F.lit("part")), F.lit(parts))
    return [candidates.where(part == k) for k in range(parts)]


def realtime_candidates(current: DataFrame, ranked: DataFrame, rated: DataFrame,
                        n: int = LIST_SIZE) -> DataFrame:
    """Products most like the one just rated and not rated by the user, best ``n``.

    ``ranked`` is what ``ranked_sims`` gives, ``rated`` has one row per user and
    product. A user who has rated r products finds their n candidates among the
    first n + r of the list, so no more than that of a long list is joined.
    """
    mine = rated.select("user_id", "product_id")
    reach = mine.groupBy("user_id").agg((F.count("*") + n).alias("reach"))
    possible = (current.select("user_id", F.col("product_id").alias("just_rated"))
                .join(reach, "user_id", "left")
                .withColumn("reach", F.coalesce("reach", F.lit(n)))
                .join(ranked.withColumnRenamed("product_id", "just_rated"), "just_rated")
                .where("place <= reach")
                .select("user_id", F.col("rec_id").alias("product_id"), "sim", "place"))
    return topk_per_key(not_yet_rated(possible, mine), "user_id", [F.asc("place")], n).select(
        "user_id", "rank", "product_id", "sim")


def realtime_scores(candidates: DataFrame, recent: DataFrame, sims: DataFrame,
                    threshold: float = SIM_THRESHOLD, dec_sign: int = 1) -> DataFrame:
    """Score of every candidate from the recent ratings it resembles.

    Mean of similarity times rating, plus log10 of the likes, plus (or minus,
    with ``dec_sign=-1``) log10 of the dislikes. Candidates that resemble no
    recent rating get no row.
    """
    close = sims.where(F.col("sim") > threshold).select(
        F.col("product_id").alias("candidate"), F.col("rec_id").alias("seen"),
        F.col("sim").alias("likeness"))
    met = (candidates.select("user_id", F.col("product_id").alias("candidate"))
           .join(recent.select("user_id", F.col("product_id").alias("seen"), "score"), "user_id")
           .join(close, ["candidate", "seen"]))
    split = like_dislike_split(met, ["user_id", "candidate"])
    score = (F.col("mean") + F.log10(F.greatest("likes", F.lit(1)))
             + dec_sign * F.log10(F.greatest("dislikes", F.lit(1))))
    return split.select("user_id", F.col("candidate").alias("product_id"), "likes", "dislikes",
                        score.alias("score"))


def like_dislike_split(met: DataFrame, keys: list[str]) -> DataFrame:
    liked = F.col("score") > LIKE_ABOVE
    return met.groupBy(*keys).agg(
        F.avg(F.col("likeness") * F.col("score")).alias("mean"),
        F.count_if(liked).alias("likes"), F.count_if(~liked).alias("dislikes"))


def ranked_scores(scores: DataFrame) -> DataFrame:
    """Scores as a list per user, best first."""
    alike = F.round(F.col("score"), 9)
    return topk_per_key(scores, "user_id", [F.desc(alike), F.asc("product_id")], None).select(
        "user_id", "rank", "product_id", "score")
