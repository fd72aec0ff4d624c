"""All queries by name. Each takes a session and a folder of star-schema tables.

Every query reads its tables whole. Whole numbers come out as BIGINT and
fractions rounded to six places, so that results compare with other engines.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators import als, content, itemcf, realtime, search, stats, topk, upserts, vectors
from affinity.plans import feeds
from affinity.schemas import (AVERAGE_PRODUCTS, CONTENT_RECS, ITEMCF_RECS, RATING, SIM_THRESHOLD,
                              USER_RECS)
from affinity.session import cut_lineage, discard, hashed_joins, scratch_dir
from affinity.sources import files, star, tables
from affinity.streaming import queue, recs, tracking

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_SEARCH_PATTERN = "ring"
# Micro-batches of the streaming queries.
_BATCHES = 3
# Events in a file of the streaming queries, about; a micro-batch reads as many files as it takes.
_FILE_EVENTS = 100_000
# Customers share few parts, so their similarities are small.
_ORDER_THRESHOLD = 0.05


def plain(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


# --- statistics ---------------------------------------------------------------

@query
def rate_more_products(spark, d):
    return stats.rate_more_products(star.ratings_orders(spark, d))


@query
def rate_more_recently(spark, d):
    return stats.rate_more_recently(star.ratings_orders(spark, d))


@query
def average_products(spark, d):
    return stats.average_products(star.ratings_orders(spark, d))


@query
def rate_more_products_events(spark, d):
    return stats.rate_more_products(star.ratings_events(spark, d))


@query
def rate_more_recently_events(spark, d):
    return stats.rate_more_recently(star.ratings_events(spark, d))


@query
def average_products_events(spark, d):
    return stats.average_products(star.ratings_events(spark, d))


@query
def product_counts(spark, d):
    return stats.product_counts(star.ratings_orders(spark, d))


@query
def distinct_users(spark, d):
    return stats.distinct_users(star.ratings_orders(spark, d))


@query
def distinct_products(spark, d):
    return stats.distinct_products(star.ratings_orders(spark, d))


@query
def rating_triple(spark, d):
    return stats.rating_triple(star.ratings_orders(spark, d))


@query
def attach_product_counts(spark, d):
    return stats.attach_product_counts(star.ratings_orders(spark, d)).select(
        "user_id", "product_id", "event_id", "count")


# --- top-k, lists, queues ---------------------------------------------------------

def _best_of_user(spark, d):
    order = [F.desc("score"), F.asc("product_id"), F.asc("event_id")]
    return topk.topk_per_key(star.ratings_orders(spark, d), "user_id", order, 20)


@query
def topk_per_key(spark, d):
    return _best_of_user(spark, d).select("user_id", "rank", "product_id", "score")


@query
def ranked_lists(spark, d):
    return topk.flatten_lists(topk.ranked_lists(_best_of_user(spark, d), "user_id"), "user_id")


@query
def recent_ratings_queue(spark, d):
    return topk.recent_ratings_queue(star.ratings_events(spark, d))


@query
def recent_ratings_queue_orders(spark, d):
    return topk.recent_ratings_queue(star.ratings_orders(spark, d))


@query
def recent_ratings_topn(spark, d):
    return topk.recent_ratings_topn(star.ratings_events(spark, d))


# --- sources and sinks -------------------------------------------------------------

@query
def load_products(spark, d):
    path = scratch_dir(spark, "products")
    none = F.lit("")
    (star.products(spark, d).select(F.concat_ws(
        "^", "product_id", "name", none, none, "image_url", "categories", "tags").alias("value"))
     .write.text(path))
    return files.load_products(spark, path)


@query
def load_ratings(spark, d):
    path = scratch_dir(spark, "ratings")
    (star.ratings_orders(spark, d)
     .select(F.concat_ws(",", "user_id", "product_id", "score", "ts").alias("value"))
     .write.text(path))
    return files.load_ratings(spark, path)


@query
def quarantined_ratings(spark, d):
    """The log's payloads read as a rating file: none has comma-separated fields."""
    payloads = tracking.tracking_log_filter(star.log_lines(spark, d)).select("value")
    return files.quarantined(files.parse_ratings(payloads))


@query
def write_table(spark, d):
    root = scratch_dir(spark, "tables")
    tables.write_table(star.ratings_orders(spark, d), root, RATING)
    return tables.read_table(spark, root, RATING)


@query
def read_table(spark, d):
    root = scratch_dir(spark, "tables")
    tables.write_table(stats.average_products(star.ratings_orders(spark, d)), root,
                       AVERAGE_PRODUCTS)
    return tables.read_table(spark, root, AVERAGE_PRODUCTS)


@query
def read_similarity(spark, d):
    root = scratch_dir(spark, "tables")
    tables.write_table(itemcf.itemcf_lists(star.ratings_events(spark, d)), root, ITEMCF_RECS)
    return tables.read_similarity(spark, root, ITEMCF_RECS)


@query
def layout(spark, d):
    path = tables.write_layout(star.ratings_orders(spark, d), scratch_dir(spark, "layout"),
                               "product_id")
    return spark.read.parquet(path).select("product_id", "user_id", "event_id")


@query
def lookup_by_key(spark, d):
    rated = star.ratings_events(spark, d).select("product_id")
    return feeds.lookup_by_key(star.products(spark, d), rated, "product_id")


@query
def lookup_first_by_key(spark, d):
    """First rating of every product that events mention."""
    rated = star.ratings_events(spark, d).select("product_id")
    order = [F.asc("ts"), F.asc("event_id"), F.asc("user_id"), F.asc("score")]
    return feeds.lookup_by_key(star.ratings_orders(spark, d), rated, "product_id", order)


def _by_type(spark, d, purchases: bool):
    events = star.table(spark, d, "events")
    chosen = F.col("event_type") == "purchase"
    return star.events_as_ratings(events.where(chosen if purchases else ~chosen))


@query
def ratings_upsert(spark, d):
    return upserts.ratings_upsert(_by_type(spark, d, True), _by_type(spark, d, False))


@query
def ratings_upsert_orders(spark, d):
    return upserts.ratings_upsert(None, star.ratings_orders(spark, d))


# --- filters and joins -----------------------------------------------------------

@query
def similarity_threshold(spark, d):
    pairs = itemcf.itemcf_pairs(star.ratings_events(spark, d))
    return pairs.where(F.col("sim") > SIM_THRESHOLD).select("product_id", "rec_id", "sim")


@query
def like_dislike_split(spark, d):
    return realtime.like_dislike_split(
        star.ratings_orders(spark, d).withColumn("likeness", F.lit(1.0)), ["product_id"])


@query
def not_yet_rated(spark, d):
    """Views of products that the same user never bought."""
    events = star.table(spark, d, "events").where("event_type = 'view'")
    return realtime.not_yet_rated(
        star.events_as_ratings(events).select("user_id", "product_id", "event_id"),
        _by_type(spark, d, True))


@query
def products_in_list(spark, d):
    return feeds.product_in_list(star.products(spark, d), star.ratings_events(spark, d))


@query
def tracking_log_filter(spark, d):
    return tracking.tracking_log_filter(star.log_lines(spark, d))


def _parsed_log(spark, d):
    return tracking.parse_rating_event(tracking.tracking_log_filter(star.log_lines(spark, d)))


@query
def parse_rating_event(spark, d):
    return _parsed_log(spark, d).where("reason is null").drop("reason")


@query
def quarantined_events(spark, d):
    return _parsed_log(spark, d).where("reason is not null").select("event_id", "value", "reason")


def _details(spark, d, ratings):
    return feeds.product_details(star.products(spark, d), stats.average_scores(ratings))


@query
def enrich_products(spark, d):
    ratings = star.ratings_events(spark, d)
    recent = topk.recent_ratings_topn(ratings).select("user_id", "rank", "product_id")
    return feeds.enrich_products(recent, cut_lineage(_details(spark, d, ratings)))


@query
def user_resolve(spark, d):
    users = cut_lineage(upserts.user_dim(star.registrations(spark, d)))
    return upserts.resolve_users(star.rating_requests(spark, d), users)


# --- similarity ------------------------------------------------------------------

@query
def itemcf_pairs(spark, d):
    return itemcf.itemcf_pairs(star.ratings_events(spark, d))


@query
def itemcf_pairs_dedup(spark, d):
    return itemcf.itemcf_pairs(star.ratings_events(spark, d), dedup=True)


@query
def itemcf_topk(spark, d):
    return itemcf.itemcf_topk(star.ratings_events(spark, d))


@query
def itemcf_topk_orders(spark, d):
    return itemcf.itemcf_topk(star.ratings_orders(spark, d))


def _bags(spark, d):
    return content.content_tokens(star.products(spark, d))


@query
def content_tokens(spark, d):
    return _bags(spark, d).select("product_id", F.posexplode("tokens").alias("pos", "token"))


@query
def content_hashed_tf(spark, d):
    bags = content.hashed_bags(star.products(spark, d))
    return bags.select("product_id", F.explode("tokens").alias("bucket")).groupBy(
        "product_id", "bucket").agg(F.count("*").alias("tf"))


@query
def content_tfidf(spark, d):
    return content.content_tfidf(_bags(spark, d))


@query
def content_pairs(spark, d):
    return content.content_pairs(_bags(spark, d))


@query
def content_topk(spark, d):
    return content.content_topk(_bags(spark, d))


@query
def content_topk_hashed(spark, d):
    return content.content_topk(cut_lineage(content.hashed_bags(star.products(spark, d))))


@query
def dense_cosine_pairs(spark, d):
    return vectors.dense_cosine_pairs(star.item_vectors(spark, d), id_col="vec_id",
                                      vector_col="embedding")


@query
def dense_cosine_topk(spark, d):
    pairs = vectors.dense_cosine_pairs(star.item_vectors(spark, d), id_col="vec_id",
                                       vector_col="embedding", k=20)
    return vectors.ranked_pairs(pairs, "vec_id", 20)


# --- matrix factorisation ----------------------------------------------------------

@query
def als_train(spark, d):
    return als.als_factors(als.als_train(star.ratings_events(spark, d)))


@query
def als_user_recs(spark, d):
    return als.als_user_recs(als.als_train(star.ratings_events(spark, d)))


@query
def als_user_recs_unseen(spark, d):
    ratings = star.ratings_events(spark, d)
    rated = cut_lineage(ratings.select("user_id", "product_id").distinct())
    return als.als_user_recs_unseen(als.als_train(ratings), rated)


@query
def als_product_recs(spark, d):
    return als.als_product_recs(als.als_train(star.ratings_events(spark, d)))


@query
def als_predict(spark, d):
    train, test = als.train_test_split(star.ratings_events(spark, d))
    return als.als_predict(als.als_train(train), test)


@query
def als_rmse(spark, d):
    train, test = als.train_test_split(star.ratings_events(spark, d))
    return als.eval_rmse(als.als_predict(als.als_train(train), test))


@query
def als_grid_search(spark, d):
    return als.als_grid_search(star.ratings_events(spark, d))


@query
def best_of_grid(spark, d):
    return als.best_of_grid(als.als_grid_search(star.ratings_events(spark, d)))


@query
def train_test_split(spark, d):
    return als.with_split(star.ratings_orders(spark, d)).select(
        "user_id", "product_id", "event_id", "split")


@query
def eval_rmse(spark, d):
    train, test = als.train_test_split(star.ratings_orders(spark, d))
    return als.eval_rmse(als.product_mean_predict(train, test))


# --- re-scoring -------------------------------------------------------------------

def _event_sims(spark, d):
    return cut_lineage(realtime.ranked_sims(itemcf.itemcf_pairs(star.ratings_events(spark, d))))


def _rescore_inputs(spark, d):
    recent, rated = realtime.realtime_inputs(star.ratings_events(spark, d))
    return cut_lineage(recent), cut_lineage(rated), _event_sims(spark, d)


@query
def realtime_candidates(spark, d):
    recent, rated, sims = _rescore_inputs(spark, d)
    return realtime.realtime_candidates(realtime.newest_rating(recent), sims, rated)


@query
def realtime_scores(spark, d):
    recent, rated, sims = _rescore_inputs(spark, d)
    candidates = realtime.realtime_candidates(realtime.newest_rating(recent), sims, rated)
    return realtime.ranked_scores(realtime.realtime_scores(candidates, recent, sims))


def _order_candidates(spark, d):
    """Inputs and candidates on the order tables, without a table of all pairs."""
    ratings = cut_lineage(star.ratings_orders(spark, d))
    recent, rated = (cut_lineage(df) for df in realtime.realtime_inputs(ratings))
    current = realtime.newest_rating(recent)
    rows = itemcf.user_items(ratings)
    discard(ratings)
    lists = cut_lineage(realtime.deep_lists(ratings, cut_lineage(
        realtime.list_depths(current, rated)), rows))
    candidates = cut_lineage(realtime.realtime_candidates(current, lists, rated))
    for table in (lists, rated):
        discard(table)
    return rows, recent, candidates


@query
def realtime_candidates_orders(spark, d):
    return _order_candidates(spark, d)[2]


@query
def realtime_scores_orders(spark, d):
    rows, recent, candidates = _order_candidates(spark, d)
    with hashed_joins(spark):
        sims = cut_lineage(itemcf.pair_sims(rows, realtime.scoring_keys(candidates, recent), _ORDER_THRESHOLD))
        scores = [cut_lineage(realtime.realtime_scores(part, recent, sims, _ORDER_THRESHOLD))
                  for part in realtime.candidate_parts(candidates, recent, rows)]
    return realtime.ranked_scores(reduce(DataFrame.unionByName, scores))


# --- streams ----------------------------------------------------------------------

def _events_as_stream(spark, d):
    """The events in several micro-batches, so that state lives on from one to the next."""
    events, parts = star.table(spark, d, "events"), scratch_dir(spark, "events")
    files = max(1, math.ceil(events.count() / _BATCHES / _FILE_EVENTS))
    events.repartition(_BATCHES * files, "event_id").write.parquet(parts)
    return tracking.stream_source(spark, "parquet", events.schema, parts, maxFilesPerTrigger=str(files))


def _event_stream(spark, d):
    return star.events_as_ratings(_events_as_stream(spark, d))


def _log_stream(spark, d):
    return star.events_as_log(_events_as_stream(spark, d))


@query
def stream_tracking_filter(spark, d):
    root = scratch_dir(spark, "tracking")
    tracking.stream_tracking_filter(_log_stream(spark, d), f"{root}/checkpoint", f"{root}/out",
                                    interval=None).awaitTermination()
    return spark.read.schema("key string, value string").parquet(f"{root}/out")


@query
def stream_log(spark, d):
    """All log lines through a stream of text files."""
    root = scratch_dir(spark, "log")
    star.log_lines(spark, d).select("value").write.text(f"{root}/log")
    lines = tracking.stream_log(spark, f"{root}/log")
    (lines.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(f"{root}/out").awaitTermination())
    return spark.read.schema(lines.schema).parquet(f"{root}/out")


@query
def log_sink(spark, d):
    """Payloads from text files forwarded with the message key."""
    root = scratch_dir(spark, "sink")
    payloads = tracking.tracking_log_filter(star.log_lines(spark, d)).select("value")
    payloads.write.text(f"{root}/payloads")
    tracking.log_sink(tracking.stream_log(spark, f"{root}/payloads"), f"{root}/checkpoint",
                      f"{root}/out", interval=None).awaitTermination()
    return spark.read.schema("key string, value string").parquet(f"{root}/out")


@query
def stream_ratings(spark, d):
    """The log as text files, filtered and parsed while streaming."""
    root = scratch_dir(spark, "ratings-stream")
    star.log_lines(spark, d).select("value").write.text(f"{root}/log")
    payloads = tracking.tracking_log_filter(tracking.stream_log(spark, f"{root}/log"))
    parsed = tracking.parse_rating_event(payloads).where("reason is null").drop("reason")
    (parsed.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start(f"{root}/out").awaitTermination())
    return spark.read.schema(parsed.schema).parquet(f"{root}/out")


@query
def stream_recent_queue(spark, d):
    root = scratch_dir(spark, "queue")
    queue.stream_recent_queue(_event_stream(spark, d), f"{root}/out", f"{root}/checkpoint",
                              interval=None).awaitTermination()
    return queue.stored_queues(spark, f"{root}/out")


def _stream_lists(spark, d):
    root = scratch_dir(spark, "recs")
    sims = _event_sims(spark, d)
    recs.stream_recs(_event_stream(spark, d), lambda: sims, root,
                     interval=None).awaitTermination()
    return recs.stored_lists(spark, root)


@query
def stream_recs(spark, d):
    return topk.flatten_lists(_stream_lists(spark, d), "user_id")


@query
def stream_recs_upsert(spark, d):
    """Stored lists per user, with their length: one row per user, empty ones too."""
    return _stream_lists(spark, d).select("user_id", F.size("recs").alias("products"))


# --- feeds ------------------------------------------------------------------------

@query
def top_rated_feed(spark, d):
    ratings = star.ratings_orders(spark, d)
    return feeds.top_rated_feed(stats.product_counts(ratings), _details(spark, d, ratings))


@query
def hot_products_feed(spark, d):
    ratings = star.ratings_orders(spark, d)
    return feeds.hot_products_feed(stats.rate_more_recently(ratings), _details(spark, d, ratings))


@query
def itemcf_for_products(spark, d):
    ratings = star.ratings_events(spark, d)
    return feeds.lists_for_products(star.products(spark, d), itemcf.itemcf_lists(ratings),
                                    cut_lineage(_details(spark, d, ratings)))


@query
def content_for_products(spark, d):
    ratings = star.ratings_events(spark, d)
    flat = content.content_topk(_bags(spark, d)).select(
        F.col("product_id").alias("owner"), "rank", F.col("rec_id").alias("product_id"),
        F.col("sim").alias("score"))
    lists = topk.ranked_lists(flat, "owner").withColumnRenamed("owner", "product_id")
    root = scratch_dir(spark, "tables")
    tables.write_table(lists, root, CONTENT_RECS)
    return feeds.lists_for_products(ratings, tables.read_table(spark, root, CONTENT_RECS),
                                    cut_lineage(_details(spark, d, ratings)))


def _customers(spark, d):
    return star.table(spark, d, "customer").select(
        F.col("c_name").alias("username"), F.col("c_custkey").alias("user_id"))


@query
def als_for_users(spark, d):
    ratings = star.ratings_events(spark, d)
    lists = topk.ranked_lists(als.als_user_recs(als.als_train(ratings)), "user_id")
    root = scratch_dir(spark, "tables")
    tables.write_table(lists, root, USER_RECS)
    users = _customers(spark, d)
    return feeds.lists_for_users(users, users, tables.read_table(spark, root, USER_RECS),
                                 cut_lineage(_details(spark, d, ratings)))


@query
def stream_for_users(spark, d):
    users = _customers(spark, d)
    return feeds.lists_for_users(users, users, _stream_lists(spark, d),
                                 cut_lineage(_details(spark, d, star.ratings_events(spark, d))))


@query
def product_info(spark, d):
    averages = stats.average_scores(star.ratings_orders(spark, d))
    return feeds.product_info(star.ratings_events(spark, d), star.products(spark, d), averages)


@query
def product_search(spark, d):
    averages = stats.average_scores(star.ratings_events(spark, d))
    return feeds.product_search(star.products(spark, d), averages, _SEARCH_PATTERN)


@query
def product_search_indexed(spark, d):
    """The same through an index of trigrams, which is written once and searched sorted."""
    products = star.products(spark, d)
    path = tables.write_layout(search.name_index(products), scratch_dir(spark, "names"), "gram")
    averages = stats.average_scores(star.ratings_events(spark, d))
    return feeds.product_search(products, averages, _SEARCH_PATTERN, index=spark.read.parquet(path))


def _intake(spark, d):
    users = cut_lineage(upserts.user_dim(star.registrations(spark, d)))
    return feeds.rating_intake(star.rating_requests(spark, d), users)


@query
def rating_intake(spark, d):
    return _intake(spark, d)[0]


@query
def rating_intake_queue(spark, d):
    return _intake(spark, d)[1]


@query
def rating_intake_log(spark, d):
    return _intake(spark, d)[2]


@query
def user_dim(spark, d):
    return upserts.user_dim(star.registrations(spark, d)).drop("pref_genres")


@query
def user_id_collisions(spark, d):
    """Each customer registers under two more names, which differ in letters of equal hash."""
    users = star.registrations(spark, d)
    named = [users.withColumn("username", F.concat(F.lit(lead), F.col("username")))
             for lead in ("", "Aa", "BB")]
    everyone = named[0].unionByName(named[1]).unionByName(named[2])
    return upserts.user_id_collisions(upserts.user_dim(everyone))


@query
def user_profile_upsert(spark, d):
    """Each signup event names the user's preferred category: that of its product."""
    users = _customers(spark, d).withColumns({
        "first": F.lit(True), "ts": F.col("user_id"),
        "pref_genres": F.array().cast("array<string>")})
    signups = star.events_as_ratings(
        star.table(spark, d, "events").where("event_type = 'signup'"))
    changes = signups.join(star.products(spark, d), "product_id").select(
        "user_id", "ts", "event_id", F.lit(False).alias("first"),
        F.split("categories", r"\|").alias("pref_genres"))
    return upserts.user_profile_upsert(users, changes).select(
        "user_id", "username", "first", F.array_join("pref_genres", "|").alias("pref_genres"))
