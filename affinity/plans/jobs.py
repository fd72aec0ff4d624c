"""The batch and streaming jobs: each reads and writes named tables below a root.

The order is load, then statistics, itemcf, content, offline and evaluate in any
order, then tracking and online as streams. Feeds read what the jobs wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity import schemas
from affinity.operators import als, content, itemcf, realtime, stats, topk, upserts
from affinity.plans import feeds
from affinity.session import cut_lineage
from affinity.sources import files, merged, tables
from affinity.streaming import queue, recs, tracking


def load(spark: SparkSession, root: str, products_path: str, ratings_path: str) -> None:
    """Text files to the product and rating tables; bad lines to quarantine tables."""
    for name, parsed in (
            (schemas.PRODUCT, files.parse_products(spark.read.text(products_path))),
            (schemas.RATING, files.parse_ratings(spark.read.text(ratings_path)))):
        tables.write_table(files.accepted(parsed), root, name)
        (files.quarantined(parsed).write.mode("overwrite")
         .parquet(tables.table_path(root, f"{name}_quarantine")))


def statistics(spark: SparkSession, root: str) -> None:
    ratings = tables.read_table(spark, root, schemas.RATING)
    for name, table in ((schemas.RATE_MORE_PRODUCTS, stats.rate_more_products(ratings)),
                        (schemas.RATE_MORE_RECENTLY, stats.rate_more_recently(ratings)),
                        (schemas.AVERAGE_PRODUCTS, stats.average_products(ratings))):
        tables.write_table(table, root, name)


def itemcf_lists(spark: SparkSession, root: str, k: int = schemas.LIST_SIZE) -> None:
    ratings = tables.read_table(spark, root, schemas.RATING)
    tables.write_table(itemcf.itemcf_lists(ratings, k), root, schemas.ITEMCF_RECS)


def content_lists(spark: SparkSession, root: str, k: int = schemas.LIST_SIZE,
                  hashed: bool = True) -> None:
    """Lists by tags: in hash buckets by default, by whole words on demand."""
    products = tables.read_table(spark, root, schemas.PRODUCT)
    bags = content.hashed_bags(products) if hashed else content.content_tokens(products)
    flat = content.content_topk(bags, k).select(
        F.col("product_id").alias("owner"), "rank", F.col("rec_id").alias("product_id"),
        F.col("sim").alias("score"))
    lists = topk.ranked_lists(flat, "owner", k).withColumnRenamed("owner", "product_id")
    tables.write_table(lists, root, schemas.CONTENT_RECS)


def offline(spark: SparkSession, root: str, k: int = schemas.LIST_SIZE,
            similar_k: int | None = None) -> None:
    """Lists per user and similar products from the learned factors.

    ``similar_k`` bounds the stored similar products of a product; the online job finds
    candidates for a user who has rated r products among the first n + r of them.
    """
    model = als.als_train(tables.read_table(spark, root, schemas.RATING))
    tables.write_table(topk.ranked_lists(als.als_user_recs(model, k), "user_id", k), root,
                       schemas.USER_RECS)
    similar = als.als_product_recs(model, k=similar_k).withColumnRenamed("rank", "place")
    tables.write_table(similar, root, schemas.PRODUCT_RECS)


def evaluate(spark: SparkSession, root: str, **grid) -> DataFrame:
    """The best point of the grid on held-out ratings."""
    return als.best_of_grid(
        als.als_grid_search(tables.read_table(spark, root, schemas.RATING), **grid))


def track(log: DataFrame, root: str, interval: str | None = tracking.BATCH_INTERVAL,
          fmt: str = "text", path: str | None = None, **sink: str) -> StreamingQuery:
    """Rating payloads of the tracking log to a topic, or to files below the root."""
    payloads = tracking.tracking_log_filter(log)
    checkpoint = tables.table_path(root, "tracking_checkpoint")
    if fmt == "text":
        return (payloads.select("value").writeStream.format("text")
                .option("checkpointLocation", checkpoint).trigger(
                    **tracking.trigger_options(interval))
                .start(path or tables.table_path(root, "payloads")))
    return tracking.log_sink(payloads, checkpoint, path, fmt, interval, **sink)


def register_users(registrations: DataFrame, root: str) -> None:
    """Add the users of ``username, ts`` rows whose names are not registered yet."""
    spark = registrations.sparkSession
    users = upserts.user_dim(registrations)
    if tables.has_table(spark, root, schemas.USER):
        known = tables.read_table(spark, root, schemas.USER)
        users = known.unionByName(users.join(known, "username", "left_anti"))
    tables.write_table(users, root, schemas.USER)


def update_profiles(changes: DataFrame, root: str) -> None:
    """Apply ``user_id, ts, event_id, first, pref_genres`` rows to the users."""
    users = tables.read_table(changes.sparkSession, root, schemas.USER)
    tables.write_table(upserts.user_profile_upsert(users, changes), root, schemas.USER)


def intake(requests: DataFrame, root: str, commit: str | None = None) -> bool:
    """Submitted ratings to the rating table, and their log lines to the log folder.

    Rows have ``username, product_id, score, ts, event_id``; without ``ts`` it is now. What is written is
    of the size of the requests. ``commit`` names them, by default after their content: a job that is
    repeated adds nothing, and finishes what one that failed has left. False if it was applied before.
    """
    spark = requests.sparkSession
    requests = cut_lineage(requests)
    if commit is None:
        whole = requests.agg(F.count("*"), F.sum(F.xxhash64(*requests.columns).cast("decimal(38, 0)"))).first()
        commit = f"intake-{whole[0]}-{whole[1]}"
    if "ts" not in requests.columns:
        requests = cut_lineage(requests.withColumn("ts", F.unix_timestamp()))
    users = tables.read_table(spark, root, schemas.USER)
    ratings, _, lines = feeds.rating_intake(requests, users)
    stored = tables.rating_table(spark, root)
    if not merged.exists(spark, stored.path) and tables.has_table(spark, root, schemas.RATING):
        stored.reset(tables.current_path(spark, root, schemas.RATING))
    staged = f"{tables.table_path(root, 'log_staged')}/{commit}"
    if not stored.applied(commit):
        lines.select("value").write.mode("overwrite").text(staged)
    added = stored.add(ratings, commit)
    files.move_files(spark, staged, tables.table_path(root, "log"), commit)
    return added


def queue_ratings(payloads: DataFrame, root: str,
                  interval: str | None = tracking.BATCH_INTERVAL) -> StreamingQuery:
    """Each user's recent ratings from a stream of payloads; ``stored_queues`` reads them."""
    state = tables.table_path(root, "queue_state")
    return queue.stream_recent_queue(_events(payloads), f"{state}/queues", f"{state}/checkpoint",
                                     interval=interval)


def stored_queues(spark: SparkSession, root: str) -> DataFrame:
    """Each user's newest ratings so far, as the stream left them."""
    return queue.stored_queues(spark, f"{tables.table_path(root, 'queue_state')}/queues")


def _events(payloads: DataFrame) -> DataFrame:
    return tracking.parse_rating_event(payloads).where("reason is null").select(
        "user_id", "product_id", "score", "ts", F.xxhash64("value").alias("event_id"))


def online_state(root: str) -> str:
    """Where the online job keeps ratings, lists and its checkpoint, apart from the tables."""
    return tables.table_path(root, "online_state")


def online(payloads: DataFrame, root: str, interval: str | None = tracking.BATCH_INTERVAL,
           n: int = schemas.LIST_SIZE) -> StreamingQuery:
    """Personal lists from a stream of payloads, on the offline job's similar products."""
    spark = payloads.sparkSession
    events = _events(payloads)
    base = (tables.rating_table(spark, root).read() if merged.exists(spark, tables.table_path(root, schemas.RATING))
            else tables.read_table(spark, root, schemas.RATING).withColumn("event_id", F.lit(tables.NO_EVENT)))
    return recs.stream_recs(
        events, lambda: tables.read_table(spark, root, schemas.PRODUCT_RECS),
        online_state(root), base=base, interval=interval, n=n)


def served_details(spark: SparkSession, root: str) -> DataFrame:
    """Products with their average score, written for the feeds."""
    return cut_lineage(feeds.product_details(
        tables.read_table(spark, root, schemas.PRODUCT),
        tables.read_table(spark, root, schemas.AVERAGE_PRODUCTS)))


def stream_lists(spark: SparkSession, root: str) -> DataFrame:
    """The newest personal lists, straight from the stream's own files."""
    return recs.stored_lists(spark, online_state(root))


def publish_stream_lists(spark: SparkSession, root: str) -> None:
    """The newest personal lists as the named table."""
    tables.write_table(stream_lists(spark, root), root, schemas.STREAM_RECS)


def similar_products(ratings: DataFrame) -> DataFrame:
    """Co-rating similarities in the form the online job reads."""
    return realtime.ranked_sims(itemcf.itemcf_pairs(ratings))
