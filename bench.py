"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of cores. Every query
is run to the end with all its rows; nothing is kept between queries.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from affinity.plans.catalogue import QUERIES
from affinity.session import build_session

HEADLINE = [
    "rate_more_products", "rate_more_recently", "average_products", "top_rated_feed",
    "hot_products_feed", "ratings_upsert_orders", "recent_ratings_queue_orders",
    "itemcf_pairs", "itemcf_topk", "itemcf_topk_orders", "content_tfidf", "content_pairs",
    "content_topk", "dense_cosine_pairs", "realtime_candidates", "realtime_scores",
    "realtime_candidates_orders", "realtime_scores_orders",
    "als_user_recs", "als_product_recs", "eval_rmse", "stream_tracking_filter",
    "stream_recent_queue", "stream_recs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = build_session("bench", cpus)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start the engine
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
