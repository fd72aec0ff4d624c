"""A key with a third of the rows is split, not sent to one task."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import content, realtime, stats, upserts
from affinity.plans import feeds
from affinity.session import cut_lineage


@pytest.fixture
def eager_skew_handling(spark):
    """Make the adaptive planner treat these small tables as if they were large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_ratings(spark):
    """60,000 ratings in several files, a third of them of product 7."""
    return spark.range(0, 60000, 1, 8).select(
        (F.col("id") % 5000).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("product_id"),
        F.lit(4.0).alias("score"), F.col("id").alias("ts"), F.col("id").alias("event_id"))


def test_hot_product_is_split_in_count_join(eager_skew_handling, hot_ratings):
    assert "skew=true" in final_plan(stats.attach_product_counts(hot_ratings))


def test_hot_product_is_split_in_enrichment(eager_skew_handling, spark, hot_ratings):
    products = spark.range(1000).select(
        F.col("id").alias("product_id"), F.lit("n").alias("name"), F.lit("u").alias("image_url"),
        F.lit("c").alias("categories"), F.lit("t").alias("tags"))
    details = cut_lineage(feeds.product_details(products, stats.average_scores(hot_ratings)))
    df = feeds.enrich_products(hot_ratings, details)
    assert "skew=true" in final_plan(df)
    assert df.count() == 60000


def test_hot_product_is_split_in_candidates(eager_skew_handling, spark, hot_ratings):
    current = hot_ratings.select(F.col("event_id").alias("user_id"), "product_id")
    sims = spark.range(997 * 3).select((F.col("id") % 997).alias("product_id"),
                                       (F.col("id") % 991 + 1000).alias("rec_id"),
                                       (F.lit(1.0) / (F.col("id") + 1)).alias("sim"))
    df = realtime.realtime_candidates(current, cut_lineage(realtime.ranked_sims(sims)), current, 2)
    assert "skew=true" in final_plan(df)


def test_hot_user_is_split_when_names_are_resolved(eager_skew_handling, spark, hot_ratings):
    named = hot_ratings.select(F.col("product_id").cast("string").alias("username"), "score")
    users = cut_lineage(upserts.user_dim(named.select("username", F.lit(1).alias("ts"))))
    assert "skew=true" in final_plan(upserts.resolve_users(named, users))


def test_hot_term_is_split(eager_skew_handling, hot_ratings):
    bags = hot_ratings.select(F.col("event_id").alias("product_id"), F.array(
        F.col("product_id").cast("string")).alias("tokens"))
    assert "skew=true" in final_plan(content.content_tfidf(bags))
