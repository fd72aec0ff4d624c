"""Personal lists that follow the rating stream."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity.operators.realtime import (newest_rating, ranked_scores, realtime_candidates,
                                         realtime_inputs, realtime_scores)
from affinity.operators.topk import ranked_lists
from affinity.schemas import LIST_SIZE, SCHEMAS, STREAM_RECS
from affinity.streaming.changelog import (drop_folder, exists, generation, generation_path,
                                          newest_generation, read_batches, read_latest,
                                          write_batch)
from affinity.streaming.tracking import BATCH_INTERVAL, trigger_options

#: Base ratings in a user bucket, about: some 100 MB of files.
BUCKET_RATINGS = 4_000_000
LEAST_BUCKETS = 32
#: Batches in a generation of the history and of the lists.
COMPACT_EVERY = 64
# Batch number of the ratings from before the stream.
BEFORE_STREAM = -1
HISTORY_SCHEMA = ("user_id long, product_id long, score double, ts long, event_id long, "
                  "user_bucket int")
LISTS_SCHEMA = SCHEMAS[STREAM_RECS]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def stored_buckets(spark: SparkSession, root: str, base: DataFrame | None,
                   wanted: int | None = None) -> int:
    """The number of user buckets, fixed at a stream's first start by the size of its base."""
    layout = f"{root}/layout"
    if not exists(spark, layout):
        count = base.count() if base is not None and wanted is None else 0
        buckets = wanted or max(LEAST_BUCKETS, math.ceil(count / BUCKET_RATINGS))
        spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(layout)
    return spark.read.schema("buckets int").parquet(layout).first().buckets


def stored_lists(spark: SparkSession, root: str) -> DataFrame:
    """Every user's newest list, ``user_id, recs``."""
    return read_latest(spark, newest_generation(spark, f"{root}/lists"), "user_id", LISTS_SCHEMA)


def user_lists(touched: DataFrame, recent: DataFrame, rated: DataFrame, ranked: DataFrame,
               n: int = LIST_SIZE) -> DataFrame:
    """One nested list per touched user from the ratings known so far; may be empty."""
    candidates = realtime_candidates(newest_rating(recent), ranked, rated, n)
    scores = ranked_scores(realtime_scores(candidates, recent, ranked))
    lists = ranked_lists(scores, "user_id", n)
    empty = F.array().cast(LISTS_SCHEMA["recs"].dataType)
    return touched.join(lists, "user_id", "left").select(
        "user_id", F.coalesce("recs", empty).alias("recs"))


def stream_recs(ratings: DataFrame, sims: Callable[[], DataFrame], root: str,
                base: DataFrame | None = None, interval: str | None = BATCH_INTERVAL,
                buckets: int | None = None, n: int = LIST_SIZE,
                compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Re-score the users of every micro-batch and store their new lists.

    ``base`` holds the ratings from before the stream. ``sims`` gives the written
    table of ``ranked_sims``; it is asked for in each batch, so a refreshed table
    is used from the next batch on.
    A user's list depends on their newest rating by time, not on the order of
    arrival. Ratings are kept by user bucket, sorted by user, and a batch reads the
    buckets of its own users only. Every ``compact_every`` batches a new generation
    begins: it holds what came before as one batch, so a batch never lists or reads
    more than that many folders. It is made of finished batches only, so a batch that
    is run again makes the same generation again. The generation before the last goes.
    """
    spark = ratings.sparkSession
    history_path, lists_path = f"{root}/history", f"{root}/lists"
    buckets = stored_buckets(spark, root, base, buckets)

    def remember(rows: DataFrame, path: str, batch_id: int) -> None:
        bucketed = rows.select("user_id", "product_id", "score", "ts", "event_id",
                               _bucket(buckets).alias("user_bucket"))
        write_batch(bucketed, path, batch_id, "user_bucket")

    def begin_generation(first: int) -> None:
        before = generation(first - 1, compact_every)
        old = generation_path(history_path, before)
        remember(read_batches(spark, old, HISTORY_SCHEMA).where(F.col("batch_id") < first),
                 generation_path(history_path, first), BEFORE_STREAM)
        lists = read_latest(spark, generation_path(lists_path, before), "user_id", LISTS_SCHEMA)
        write_batch(lists, generation_path(lists_path, first), BEFORE_STREAM)
        for path in (history_path, lists_path):
            drop_folder(spark, generation_path(path, before - compact_every))

    def process(batch: DataFrame, batch_id: int) -> None:
        first = generation(batch_id, compact_every)
        if batch_id == first > 0:
            begin_generation(first)
        path = generation_path(history_path, first)
        remember(batch, path, batch_id)
        stored = read_batches(spark, path, HISTORY_SCHEMA)
        new = stored.where(F.col("batch_id") == batch_id)
        # At most ``buckets`` values.
        met = [r.user_bucket for r in new.select("user_bucket").distinct().collect()]
        touched = new.select("user_id").distinct()
        mine = stored.where(F.col("user_bucket").isin(met)).join(touched, "user_id", "left_semi")
        recent, rated = (df.persist() for df in realtime_inputs(mine))
        try:
            write_batch(user_lists(touched, recent, rated, sims(), n),
                        generation_path(lists_path, first), batch_id)
        finally:
            recent.unpersist()
            rated.unpersist()

    start = generation_path(history_path, 0)
    if base is not None and not exists(spark, f"{root}/base"):
        remember(base, start, BEFORE_STREAM)
        # The marker comes last: a start that fails before it writes the base again.
        spark.range(0).write.mode("overwrite").parquet(f"{root}/base")
    return (ratings.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**trigger_options(interval)).start())
