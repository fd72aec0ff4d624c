"""Latest-row-wins merges of ratings, users and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.scalars import java_string_hash
from affinity.operators.topk import newest_first, topk_per_key


def ratings_upsert(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """One row per user and product, the newest one."""
    rows = changes if base is None else base.unionByName(changes)
    return topk_per_key(rows, ["user_id", "product_id"], newest_first(), 1).drop("rank")


def user_dim(registrations: DataFrame) -> DataFrame:
    """One user per name: the first registration wins, the id is a hash of the name."""
    first = registrations.groupBy("username").agg(F.min("ts").alias("ts"))
    return first.select(
        java_string_hash(F.col("username")).alias("user_id"), "username",
        F.lit(True).alias("first"), "ts",
        F.array().cast("array<string>").alias("pref_genres"))


def user_id_collisions(users: DataFrame) -> DataFrame:
    """Hashed ids that more than one name maps to."""
    return (users.groupBy("user_id")
            .agg(F.count("*").alias("names"), F.min("username").alias("first_name"),
                 F.max("username").alias("last_name"))
            .where("names > 1"))


def user_profile_upsert(users: DataFrame, changes: DataFrame) -> DataFrame:
    """Set the ``first`` flag and preferred genres from each user's newest change."""
    newest = topk_per_key(changes, "user_id", [F.desc("ts"), F.desc("event_id")], 1).select(
        "user_id", F.col("first").alias("new_first"), F.col("pref_genres").alias("new_genres"))
    return (users.join(newest, "user_id", "left")
            .select("user_id", "username",
                    F.coalesce("new_first", "first").alias("first"), "ts",
                    F.coalesce("new_genres", "pref_genres").alias("pref_genres")))


def resolve_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Username to user id; unknown names give no row."""
    return rows.join(users.select("username", "user_id"), "username")
