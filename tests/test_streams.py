import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from affinity.operators import itemcf, realtime, topk
from affinity.session import cut_lineage, scratch_dir
from affinity.streaming import changelog, queue, recs, tracking

SCHEMA = "user_id long, product_id long, score double, ts long, event_id long"


def events(seed, n=300):
    """A third of the events are one user's; arrival order is not time order."""
    rng = random.Random(seed)
    return [(0 if e % 3 == 0 else rng.randrange(1, 15), rng.randrange(25),
             float(rng.randint(1, 5)), rng.randrange(1000), e) for e in range(n)]


def in_files(spark, data, parts):
    """Write the events as ``parts`` files, to be streamed one file at a time."""
    path = scratch_dir(spark, "stream-input")
    size = -(-len(data) // parts)
    for i in range(parts):
        (spark.createDataFrame(data[i * size:(i + 1) * size], SCHEMA).coalesce(1)
         .write.mode("append").parquet(path))
    return path


def stream(spark, path):
    return tracking.stream_source(spark, "parquet", SCHEMA, path, maxFilesPerTrigger="1")


@pytest.mark.parametrize("value, payload", [
    ("INFO x PRODUCT_RATING_PREFIX:4867|8195|5.0|1556436808", "4867|8195|5.0|1556436808"),
    ("PRODUCT_RATING_PREFIX: 1|2|3|4 PRODUCT_RATING_PREFIX:5|6|7|8", "1|2|3|4"),
    ("INFO x 4867|8195|5.0|1556436808", None)])
def test_log_filter(spark, value, payload):
    got = tracking.tracking_log_filter(spark.createDataFrame([(value,)], "value string"))
    assert [r.value for r in got.collect()] == ([payload] if payload else [])


def test_parse_and_quarantine(spark):
    lines = ["4867|8195|5.0|1556436808", "1|2|3.5|1556436808000", "4867|x|5.0|1", "4867|8195", ""]
    got = {r.value: r for r in tracking.parse_rating_event(
        spark.createDataFrame([(v,) for v in lines], "value string")).collect()}
    first = got[lines[0]]
    assert (first.user_id, first.product_id, first.score, first.ts, first.reason) == (
        4867, 8195, 5.0, 1556436808, None)
    assert got[lines[1]].ts == 1556436808
    assert got[lines[2]].reason == "bad field"
    assert got[lines[3]].reason == got[lines[4]].reason == "too few fields"


def test_tracking_stream_forwards_payloads(spark):
    root = scratch_dir(spark, "tracking")
    lines = [(f"x PRODUCT_RATING_PREFIX:{i}|1|2.0|3",) if i % 2 else ("other",) for i in range(10)]
    spark.createDataFrame(lines, "value string").repartition(3).write.text(f"{root}/log")
    log = tracking.stream_log(spark, f"{root}/log", maxFilesPerTrigger="1")
    tracking.stream_tracking_filter(log, f"{root}/cp", f"{root}/out",
                                    interval=None).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert {tuple(r) for r in out.collect()} == {
        ("logProcessor", f"{i}|1|2.0|3") for i in range(1, 10, 2)}


def test_rating_stream_leaves_bad_lines_out(spark):
    root = scratch_dir(spark, "payloads")
    spark.createDataFrame([("1|2|3.0|4",), ("1|x|3.0|4",)], "value string").write.text(f"{root}/in")
    good = tracking.stream_ratings(spark, f"{root}/in")
    (good.writeStream.format("parquet").option("checkpointLocation", f"{root}/cp")
     .trigger(availableNow=True).start(f"{root}/out").awaitTermination())
    assert [(r.user_id, r.product_id, r.score, r.ts)
            for r in spark.read.parquet(f"{root}/out").collect()] == [(1, 2, 3.0, 4)]


@pytest.mark.parametrize("parts, shuffled", [(1, False), (3, False), (3, True)])
def test_queue_stream_equals_batch(spark, parts, shuffled):
    data = events(1)
    if shuffled:
        random.Random(9).shuffle(data)
    root = scratch_dir(spark, "queue")
    queue.stream_recent_queue(stream(spark, in_files(spark, data, parts)), f"{root}/out",
                              f"{root}/cp", size=7, interval=None).awaitTermination()
    got = changelog.read_latest(spark, f"{root}/out", "user_id", queue.QUEUE_SCHEMA)
    batch = topk.recent_ratings_queue(spark.createDataFrame(data, SCHEMA), 7)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in batch.collect()}
    compacted = f"{root}/compacted"
    changelog.compact(spark, f"{root}/out", compacted, "user_id", queue.QUEUE_SCHEMA)
    again = changelog.read_latest(spark, compacted, "user_id", queue.QUEUE_SCHEMA)
    assert again.exceptAll(got).isEmpty() and got.exceptAll(again).isEmpty()


def test_queue_files_stay_bounded(spark):
    """Twelve batches in generations of three: readers see a few folders, and the same queues."""
    data = events(4)
    root = scratch_dir(spark, "queue")
    queue.stream_recent_queue(stream(spark, in_files(spark, data, 12)), f"{root}/out", f"{root}/cp", size=5,
                              interval=None, compact_every=3).awaitTermination()
    got = queue.stored_queues(spark, f"{root}/out")
    batch = topk.recent_ratings_queue(spark.createDataFrame(data, SCHEMA), 5)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in batch.collect()}
    assert got.count() == batch.count()
    generations = os.listdir(f"{root}/out")
    assert len(generations) <= 2
    assert max(len(os.listdir(f"{root}/out/{g}")) for g in generations) <= 3 + 1


def batch_lists(spark, data, sims, n):
    df = spark.createDataFrame(data, SCHEMA)
    recent, rated = realtime.realtime_inputs(df)
    scores = realtime.realtime_scores(realtime.realtime_candidates(
        realtime.newest_rating(recent), sims, rated, n), recent, sims)
    out = {u: [] for u in {d[0] for d in data}}
    for r in realtime.ranked_scores(scores).orderBy("user_id", "rank").collect():
        out[r.user_id].append((r.product_id, round(r.score, 9)))
    return out


@pytest.mark.parametrize("parts, with_base, every", [(3, False, 64), (2, True, 64), (7, True, 2)])
def test_list_stream_equals_batch(spark, parts, with_base, every):
    data = events(2, 200)
    random.Random(4).shuffle(data)
    sims = cut_lineage(realtime.ranked_sims(
        itemcf.itemcf_pairs(spark.createDataFrame(events(5), SCHEMA))))
    base, new = (data[:80], data[80:]) if with_base else ([], data)
    root = scratch_dir(spark, "recs")
    recs.stream_recs(stream(spark, in_files(spark, new, parts)), lambda: sims, root,
                     base=spark.createDataFrame(base, SCHEMA) if base else None,
                     interval=None, buckets=4, n=5, compact_every=every).awaitTermination()
    kept = sorted(p.name for p in Path(root, "history").iterdir() if p.is_dir())
    assert kept == (["generation=4", "generation=6"] if every == 2 else ["generation=0"])
    assert max(len(list(p.glob("batch_id=*"))) for p in Path(root, "history").iterdir()) <= every + 1
    lists = recs.stored_lists(spark, root)
    got = {r.user_id: [(x.product_id, round(x.score, 9)) for x in r.recs] for r in lists.collect()}
    touched = {d[0] for d in new}
    expected = {u: v for u, v in batch_lists(spark, data, sims, 5).items() if u in touched}
    assert got == expected


def test_a_repeated_batch_replaces_its_rows(spark):
    path = scratch_dir(spark, "log")
    rows = lambda *r: spark.createDataFrame(list(r), "user_id long, v long")
    changelog.write_batch(rows((1, 10), (2, 20)), path, 0)
    changelog.write_batch(rows((1, 11)), path, 1)
    changelog.write_batch(rows((1, 11)), path, 1)
    got = changelog.read_latest(spark, path, "user_id", "user_id long, v long")
    assert {tuple(r) for r in got.collect()} == {(1, 11), (2, 20)}


def test_hot_user_is_thinned_before_the_state_shuffle(spark):
    path = in_files(spark, events(3), 1)
    plan = queue.recent_queue_updates(stream(spark, path)).select(F.col("user_id"))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert text.index("FlatMapGroupsInPandasWithState") < text.index("MapInPandas")


def test_base_is_written_once_and_buckets_stay(spark):
    root = scratch_dir(spark, "layout")
    base = spark.createDataFrame(events(3, 50), SCHEMA)
    assert recs.stored_buckets(spark, root, base, 7) == 7
    assert recs.stored_buckets(spark, root, base) == 7


def test_generations_of_a_change_log(spark):
    assert [changelog.generation(b, 3) for b in range(7)] == [0, 0, 0, 3, 3, 3, 6]
    root = scratch_dir(spark, "generations")
    assert changelog.newest_generation(spark, root).endswith("generation=0")
    for first in (0, 3):
        changelog.write_batch(spark.range(1), changelog.generation_path(root, first), first)
    assert changelog.newest_generation(spark, root).endswith("generation=3")
    changelog.drop_folder(spark, changelog.generation_path(root, 0))
    assert not changelog.exists(spark, f"{changelog.generation_path(root, 0)}/batch_id=0")


def test_a_micro_batch_has_as_many_files_as_its_events_ask_for(spark, tmp_path, monkeypatch):
    from affinity.plans import catalogue
    spark.range(120).selectExpr("id as event_id", "id % 7 as user_id").write.parquet(f"{tmp_path}/events.parquet")
    asked = []
    monkeypatch.setattr(catalogue, "_FILE_EVENTS", 10)
    monkeypatch.setattr(catalogue.tracking, "stream_source", lambda spark, kind, schema, path, maxFilesPerTrigger:
                        asked.append((maxFilesPerTrigger, spark.read.parquet(path))))
    catalogue._events_as_stream(spark, str(tmp_path))
    files, events = asked[0]
    assert files == "4" and len(events.inputFiles()) > 4 and events.count() == 120
