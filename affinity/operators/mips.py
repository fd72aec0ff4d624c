"""Best products of every user by inner product of factors: exact, and not users times products.

Products are cut into blocks by falling length. By Cauchy and Schwarz no product of a block scores
more than the user's length times the block's longest product, so a user whose k-th best reaches
that needs neither this block nor any after it. Blocks are taken in rounds of doubling width; a round
sends the users that still need them to the blocks, and keeps k products per user.

Rated products come to the cell of their user and product, and are masked in its table of scores;
no list is longer than k for them, however many a user has rated.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.topk import topk_per_key
from affinity.session import cut_lineage

#: Users and products in a block, about, and users that are scored at a time.
USER_BLOCK, PRODUCT_BLOCK, TILE_USERS = 8192, 4096, 512
# More than a computed product can be off, as a share of the two lengths.
SLACK = 1e-9


def _lengths(factors: DataFrame) -> DataFrame:
    """``id, features, length`` of the factors that are not zero."""
    square = F.aggregate(F.col("features").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
    return factors.select(F.col("id").cast("long").alias("id"), "features",
                          F.sqrt(square).alias("length")).where("length > 0")


def _blocks(products: DataFrame, block_rows: int) -> DataFrame:
    """``id, features, length, pb, part``, written: block numbers ascend as lengths fall.

    Blocks come from quantiles of the lengths; one that has more rows, of equal length, is in parts.
    """
    count = products.count()
    shares = [i / n for n in [max(1, math.ceil(count / block_rows))] for i in range(1, n)]
    edges = sorted(set(products.approxQuantile("length", shares, 0.1 / len(shares))), reverse=True) if shares else []
    below: Column = F.lit(0)
    if edges:
        below = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e > F.col("length")))
    cut = cut_lineage(products.withColumn("pb", below.cast("int")))
    sizes = cut.groupBy("pb").agg(F.ceil(F.count("*") / (2 * block_rows)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int")
    # One row per block.
    return cut_lineage(cut.join(F.broadcast(sizes), "pb").withColumn("part", part).drop("parts"))


def best_products(users: DataFrame, products: DataFrame, k: int, rated: DataFrame | None = None,
                  user_block: int = USER_BLOCK, product_block: int = PRODUCT_BLOCK) -> DataFrame:
    """``user_id, rank, product_id, score``: every user's best ``k`` with a positive score.

    ``users`` and ``products`` are ``id, features``. The pairs ``user_id, product_id`` of ``rated``,
    a written table, are left out; it may repeat pairs and name unknown ones.
    """
    spark = users.sparkSession
    placed = _blocks(cut_lineage(_lengths(products)), product_block)
    longest = [tuple(r) for r in placed.groupBy("pb", "part").agg(F.max("length").alias("longest"))
               .orderBy("pb", "part").collect()]  # one row per part of a block
    seekers = cut_lineage(_lengths(users))
    parts = max(1, math.ceil(seekers.count() / user_block))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    seekers = seekers.select("id", "features", "length", part.alias("ub"))
    if rated is None:
        seen = spark.createDataFrame([], "ub int, pb int, part int, user_id long, product_id long")
    else:
        seen = cut_lineage(rated.select("user_id", F.col("product_id").alias("id"))
                           .join(placed.select("id", "pb", "part"), "id")
                           .select(F.pmod(F.xxhash64(F.col("user_id").cast("long")), F.lit(parts)).cast("int").alias("ub"),
                                   "pb", "part", F.col("user_id").cast("long").alias("user_id"), F.col("id").alias("product_id")))

    lists = spark.createDataFrame([], "user_id long, product_id long, score double")
    start, width = 0, 1
    while start < len(longest):
        some = longest[start:start + width]
        block = spark.createDataFrame(some, "pb int, part int, longest double")
        best = F.col("length") * F.col("longest") * (1 + SLACK)
        # One row per part of the round's blocks.
        wanted = cut_lineage(_with_kth(seekers, lists, k).join(F.broadcast(block), best >= F.col("kth"))
                             .drop("longest"))
        if wanted.isEmpty():
            break
        cells = wanted.select("ub", "pb", "part").distinct()
        vectors = (wanted.select("ub", "pb", "part", F.lit(True).alias("seeks"), "id", "features", "kth").unionByName(
            cells.join(placed, ["pb", "part"]).select("ub", "pb", "part", F.lit(False).alias("seeks"), "id",
                                                      "features", F.lit(0.0).alias("kth"))))
        mine = seen.where(F.col("pb").between(some[0][0], some[-1][0]))
        found = _scored(vectors, mine, k)
        lists = cut_lineage(topk_per_key(lists.unionByName(found), "user_id", _order(), k).drop("rank"))
        start, width = start + width, 2 * width
    return topk_per_key(lists, "user_id", _order(), k).select("user_id", "rank", "product_id", "score")


def _order() -> list[Column]:
    return [F.desc("score"), F.asc("product_id")]


def _with_kth(seekers: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """The users with the score that a product must reach: the k-th best, or anything above zero."""
    held = cut_lineage(lists.groupBy(F.col("user_id").alias("id")).agg(
        F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).drop("n"))
    return seekers.join(held, "id", "left").withColumn("kth", F.coalesce("kth", F.lit(0.0)))


def _scored(vectors: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """``user_id, product_id, score``: the best ``k`` of each user and cell, without the seen ones."""
    tile_users = TILE_USERS

    def cell(one: pa.Table, two: pa.Table) -> pa.Table:
        seeks, ids = one.column("seeks").to_numpy(zero_copy_only=False), one.column("id").to_numpy()
        out = ([], [], [])
        if seeks.any() and not seeks.all():
            flat = one.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            features = flat.reshape(len(ids), -1).astype(np.float64)
            order = np.argsort(ids[seeks])
            users, left = ids[seeks][order], features[seeks][order]
            least = one.column("kth").to_numpy()[seeks][order]
            order = np.argsort(ids[~seeks])
            products, right = ids[~seeks][order], features[~seeks][order]
            of_user, of_product = two.column("user_id").to_numpy(), two.column("product_id").to_numpy()
            known = np.isin(of_user, users) & np.isin(of_product, products)
            row = np.searchsorted(users, of_user[known])
            column = np.searchsorted(products, of_product[known])
            for first in range(0, len(users), tile_users):
                scores = left[first:first + tile_users] @ right.T
                here = (row >= first) & (row < first + tile_users)
                scores[row[here] - first, column[here]] = -np.inf
                # Equal scores are ranked by product, and products ascend.
                place = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(scores, place, 1)
                r, c = np.nonzero((value > 0) & (value >= least[first:first + tile_users, None]))
                out[0].append(users[first + r])
                out[1].append(products[place[r, c]])
                out[2].append(value[r, c])
        columns = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"user_id": pa.array(columns[0].astype(np.int64)),
                         "product_id": pa.array(columns[1].astype(np.int64)), "score": pa.array(columns[2])})

    keys = ["ub", "pb", "part"]
    return (vectors.groupBy(*keys).cogroup(seen.groupBy(*keys))
            .applyInArrow(cell, "user_id long, product_id long, score double"))
