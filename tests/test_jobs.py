"""All jobs in order on small text files, then the feeds over their tables."""

import random

import pytest
from pyspark.sql import functions as F

from affinity import schemas
from affinity.plans import feeds, jobs
from affinity.session import scratch_dir
from affinity.sources import tables
from affinity.streaming import changelog, queue, tracking


@pytest.fixture(scope="module")
def root(spark):
    rng = random.Random(8)
    base = scratch_dir(spark, "jobs")
    words = ["red", "blue", "ring", "bolt", "gear", "nut"]
    products = [f"{p}^name {p}^1,2^B{p}^/img/{p}^cat|sub^" + "|".join(rng.sample(words, 3))
                for p in range(30)] + ["broken"]
    ratings = [f"{u},{p},{float(rng.randint(1, 5))},{1395676800 + u * 50 + p}"
               for u in range(25) for p in rng.sample(range(30), 10)] + ["1,2,x,4"]
    for name, lines in (("products", products), ("ratings", ratings)):
        spark.createDataFrame([(v,) for v in lines], "value string").write.text(f"{base}/in/{name}")
    jobs.load(spark, base, f"{base}/in/products", f"{base}/in/ratings")
    jobs.statistics(spark, base)
    jobs.itemcf_lists(spark, base, 5)
    jobs.content_lists(spark, base, 5)
    jobs.offline(spark, base, 5)
    return base


def test_loaded_tables(spark, root):
    assert tables.read_table(spark, root, schemas.PRODUCT).count() == 30
    assert tables.read_table(spark, root, schemas.RATING).count() == 250
    for name in (schemas.PRODUCT, schemas.RATING):
        assert spark.read.parquet(f"{root}/{name}_quarantine").count() == 1


def test_result_tables(spark, root):
    counts = tables.read_table(spark, root, schemas.RATE_MORE_PRODUCTS)
    assert counts.agg(F.sum("count")).first()[0] == 250
    for name in (schemas.ITEMCF_RECS, schemas.CONTENT_RECS, schemas.USER_RECS):
        longest = tables.read_table(spark, root, name).agg(F.max(F.size("recs"))).first()[0]
        assert 0 < longest <= 5
    similar = tables.read_table(spark, root, schemas.PRODUCT_RECS)
    assert similar.where("sim <= 0.4 or product_id = rec_id").count() == 0


def test_feeds_over_the_tables(spark, root):
    details = jobs.served_details(spark, root)
    recently = tables.read_table(spark, root, schemas.RATE_MORE_RECENTLY)
    assert feeds.hot_products_feed(recently, details, 6).count() == 6
    ids = spark.createDataFrame([(3,), (4,)], "product_id long")
    for name in (schemas.ITEMCF_RECS, schemas.CONTENT_RECS):
        feed = feeds.lists_for_products(ids, tables.read_table(spark, root, name), details, 3)
        assert feed.count() <= 6 and feed.where("avg_score > 0").count() > 0


def test_evaluation(spark, root):
    best = jobs.evaluate(spark, root, ranks=(2, 3), lambdas=(0.1,), iterations=2)
    assert best.count() == 1


def test_log_to_personal_lists(spark, root):
    lines = [(f"INFO PRODUCT_RATING_PREFIX:{u}|{u}|5.0|1600000000",) for u in range(5)]
    spark.createDataFrame([*lines, ("noise",)], "value string").write.text(f"{root}/log")
    jobs.track(tracking.stream_log(spark, f"{root}/log"), root, interval=None).awaitTermination()
    payloads = tracking.stream_log(spark, f"{root}/payloads")
    jobs.online(payloads, root, interval=None, n=4).awaitTermination()
    lists = jobs.stream_lists(spark, root)
    rated = tables.read_table(spark, root, schemas.RATING)
    assert {r.user_id for r in lists.collect()} == set(range(5))
    flat = lists.select("user_id", F.explode("recs").alias("r")).select(
        "user_id", F.col("r.product_id").alias("product_id"))
    assert flat.join(rated, ["user_id", "product_id"], "left_semi").isEmpty()
    assert lists.agg(F.max(F.size("recs"))).first()[0] <= 4
    similar = jobs.similar_products(rated)
    assert similar.columns == tables.read_table(spark, root, schemas.PRODUCT_RECS).columns


def test_users_ratings_and_queues(spark, tmp_path):
    root = str(tmp_path / "shop")

    def register(*rows):
        jobs.register_users(spark.createDataFrame(rows, "username string, ts long"), root)

    register(("ann", 5), ("ann", 3), ("bob", 4))
    register(("ann", 1), ("cid", 9))
    users = {r.username: r for r in tables.read_table(spark, root, schemas.USER).collect()}
    assert {n: u.ts for n, u in users.items()} == {"ann": 3, "bob": 4, "cid": 9}
    jobs.update_profiles(spark.createDataFrame(
        [(users["bob"].user_id, 7, 1, False, ["tea"])],
        "user_id long, ts long, event_id long, first boolean, pref_genres array<string>"), root)
    bob = tables.read_table(spark, root, schemas.USER).where("username = 'bob'").first()
    assert bob.pref_genres == ["tea"] and not bob.first
    columns = "username string, product_id long, score double, ts long, event_id long"
    jobs.intake(spark.createDataFrame([("ann", 1, 10.0, 100, 1), ("nobody", 1, 9.0, 100, 2)], columns), root)
    jobs.intake(spark.createDataFrame([("ann", 1, 4.0, 200, 3), ("bob", 2, 7.0, 150, 4)], columns), root)
    rated = tables.read_table(spark, root, schemas.RATING)
    assert sorted((r.product_id, r.score) for r in rated.collect()) == [(1, 2.0), (2, 3.5)]
    jobs.intake(spark.createDataFrame([("cid", 5, 8.0, 6)], "username string, product_id long, score double, "
                                      "event_id long"), root)
    assert tables.read_table(spark, root, schemas.RATING).where("product_id = 5").first().ts > 1.6e9
    jobs.track(tracking.stream_log(spark, f"{root}/log"), root, interval=None).awaitTermination()
    jobs.queue_ratings(tracking.stream_log(spark, f"{root}/payloads"), root, interval=None).awaitTermination()
    queues = changelog.read_latest(spark, f"{root}/queue_state/queues", "user_id", queue.QUEUE_SCHEMA)
    assert queues.select("user_id").distinct().count() == 3
