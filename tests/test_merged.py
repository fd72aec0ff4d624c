"""The merged table against a plain upsert; intakes that are repeated, cut short, or come at once."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from affinity import schemas
from affinity.plans import jobs
from affinity.sources import merged, tables

ROWS = "user_id long, product_id long, score double, ts long, event_id long"
REQUESTS = "username string, product_id long, score double, ts long, event_id long"


def plain(rows):
    newest = {}
    for row in rows:
        u, p, score, ts, event = row
        if (u, p) not in newest or (ts, event, score) > newest[u, p][3:] + (newest[u, p][2],):
            newest[u, p] = row
    return sorted(newest.values())


def rows(df):
    return sorted(map(tuple, df.select("user_id", "product_id", "score", "ts", "event_id").collect()))


def test_many_changes_equal_one_upsert(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merged, "FAN", 3)
    monkeypatch.setattr(merged, "BUCKETS", 2)
    rng = random.Random(1)
    table = tables.rating_table(spark, str(tmp_path))
    every = []
    for k in range(10):
        batch = [(rng.randrange(6), rng.randrange(8), float(rng.randint(1, 5)), rng.randrange(5), 100 * k + i)
                 for i in range(12)]
        every += batch
        assert table.add(spark.createDataFrame(batch, ROWS), f"batch-{k}")
        assert rows(table.read()) == plain(every)
    runs = merged.manifest(spark, table.path)[1]["runs"]
    assert len(runs) <= 4 and max(r["level"] for r in runs) == 2
    assert not table.add(spark.createDataFrame(every, ROWS), "batch-3") and rows(table.read()) == plain(every)


def test_two_writers_at_once_lose_no_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merged, "BUCKETS", 2)
    conflicts = []
    create = merged._create

    def noted(*args):
        try:
            create(*args)
        except merged.Conflict as error:
            conflicts.append(error)
            raise

    monkeypatch.setattr(merged, "_create", noted)
    table = tables.rating_table(spark, str(tmp_path))
    meet = threading.Barrier(3)
    first_look = merged.manifest

    def look(*args):
        found = first_look(*args)
        if found[0] == 0 and threading.current_thread().name.startswith("writer"):
            try:
                meet.wait(20)  # all writers have seen the same state
            except threading.BrokenBarrierError:
                pass
        return found

    def write(k):
        table.add(spark.createDataFrame([(k, p, 1.0, 1, 10 * k + p) for p in range(4)], ROWS), f"w{k}")

    monkeypatch.setattr(merged, "manifest", look)
    writers = [threading.Thread(target=write, args=(k,), name=f"writer{k}") for k in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    monkeypatch.setattr(merged, "manifest", first_look)
    assert conflicts and rows(table.read()) == [(k, p, 1.0, 1, 10 * k + p) for k in range(3) for p in range(4)]


@pytest.fixture
def shop(spark, tmp_path):
    root = str(tmp_path / "shop")
    jobs.register_users(spark.createDataFrame([(f"u{k}", k) for k in range(20)], "username string, ts long"), root)
    old = spark.createDataFrame([(u, p, 3.0, random.Random(u * 200 + p).randrange(1 << 40)) for u in range(100)
                                 for p in range(200)],
                                "user_id long, product_id long, score double, ts long")
    tables.write_table(old, root, schemas.RATING)
    return root


def written(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_an_intake_writes_the_size_of_its_rows(spark, shop, monkeypatch):
    monkeypatch.setattr(merged, "BUCKETS", 2)
    before = written(f"{shop}/rating")
    jobs.intake(spark.createDataFrame([(f"u{k % 20}", k, 8.0, 200, k) for k in range(100)], REQUESTS), shop)
    assert written(f"{shop}/rating") - before < before / 3
    assert tables.read_table(spark, shop, schemas.RATING).count() == 20_000 + 100


def test_a_repeated_or_failed_intake_adds_nothing_twice(spark, shop, monkeypatch):
    monkeypatch.setattr(merged, "BUCKETS", 2)
    requests = spark.createDataFrame([("u1", 7, 10.0, 500, 1), ("u2", 7, 6.0, 501, 2), ("nobody", 7, 6.0, 1, 3)], REQUESTS)
    move = jobs.files.move_files

    def fails(*args):
        raise OSError("the job ended here")

    monkeypatch.setattr(jobs.files, "move_files", fails)
    with pytest.raises(OSError):
        jobs.intake(requests, shop)
    monkeypatch.setattr(jobs.files, "move_files", move)
    assert tables.rating_table(spark, shop).read().where("ts = 500").count() == 1
    assert not jobs.intake(requests, shop) and not jobs.intake(requests, shop)
    log = sorted(r.value for r in spark.read.text(f"{shop}/log").collect())
    assert len(log) == 2 and all(schemas.RATING_MARKER in line for line in log)
    assert tables.read_table(spark, shop, schemas.RATING).where("ts in (500, 501)").count() == 2


def test_event_ids_are_stored_and_break_ties(spark, shop, monkeypatch):
    """Ratings from before have no event; of one second's events the larger id wins, whenever it comes."""
    monkeypatch.setattr(merged, "BUCKETS", 2)
    old = spark.createDataFrame([(u, 1, 3.0, 100) for u in range(3)], "user_id long, product_id long, score double, ts long")
    tables.write_table(old, shop, schemas.RATING)
    table = tables.rating_table(spark, shop)
    table.reset(tables.current_path(spark, shop, schemas.RATING))
    table.add(spark.createDataFrame([(0, 1, 5.0, 100, -9), (1, 1, 4.0, 100, 7)], ROWS), "a")
    table.add(spark.createDataFrame([(1, 1, 2.0, 100, 6)], ROWS), "b")
    assert rows(table.read()) == [(0, 1, 5.0, 100, -9), (1, 1, 4.0, 100, 7), (2, 1, 3.0, 100, tables.NO_EVENT)]
    tables.write_table(old.limit(1), shop, schemas.RATING)
    assert tables.read_table(spark, shop, schemas.RATING).count() == 1
    assert table.read().where(F.col("event_id") == tables.NO_EVENT).count() == 1
