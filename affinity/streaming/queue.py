"""The bounded list of every user's newest ratings, kept as stream state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from affinity.schemas import QUEUE_SIZE
from affinity.streaming.changelog import (drop_folder, generation, generation_path, newest_generation,
                                          read_latest, write_batch)
from affinity.streaming.tracking import BATCH_INTERVAL, trigger_options

#: Batches in a generation of the queues, and the batch number of what came before it.
COMPACT_EVERY, BEFORE_GENERATION = 64, -1
_RATING = "user_id long, product_id long, score double, ts long, event_id long"
QUEUE_SCHEMA = "user_id long, rank int, product_id long, score double, ts long, event_id long"
_STATE = "ts array<long>, event_id array<long>, score array<double>, product_id array<long>"


def recent_queue_updates(ratings: DataFrame, size: int = QUEUE_SIZE) -> DataFrame:
    """The new queue of every user that a micro-batch touches.

    Each worker first keeps only the newest ``size`` ratings per user of its own
    rows. That is enough to find the newest overall, and a user who sends a large
    part of a batch sends little of it through the shuffle to their state.
    """
    # Newest first, in this order. The functions stand by themselves, so workers
    # need no copy of this package.
    order = ["ts", "event_id", "score", "product_id"]

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            counts = rows["user_id"].value_counts()
            many = rows["user_id"].isin(counts.index[counts > size])
            ordered = rows[many].sort_values(order, ascending=False)
            newest = ordered.groupby("user_id", sort=False).head(size)
            yield pd.concat([rows[~many], newest]) if many.any() else rows

    def update(key: tuple, batches: Iterator[pd.DataFrame],
               state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(zip(*state.get)) if state.exists else []
        for rows in batches:
            held += zip(*(rows[name].tolist() for name in order))
            held = sorted(held, reverse=True)[:size]
        columns = [list(values) for values in zip(*held)]
        state.update(tuple(columns))
        ts, event_id, score, product_id = columns
        yield pd.DataFrame({"user_id": key[0], "rank": range(1, len(held) + 1),
                            "product_id": product_id, "score": score, "ts": ts,
                            "event_id": event_id})

    thinned = ratings.select("user_id", "product_id", "score", "ts", "event_id").mapInPandas(
        thin, _RATING)
    return thinned.groupBy("user_id").applyInPandasWithState(
        update, QUEUE_SCHEMA, _STATE, "update", GroupStateTimeout.NoTimeout)


def stream_recent_queue(ratings: DataFrame, path: str, checkpoint: str,
                        size: int = QUEUE_SIZE, interval: str | None = BATCH_INTERVAL,
                        compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep the queues up to date below ``path``; ``stored_queues`` reads them.

    Every ``compact_every`` batches a new generation begins, which holds the queues so far as one
    batch, so a reader never lists more folders than that. It is made of finished batches only, so a
    batch that is run again makes it again. The generation before the last goes.
    """
    spark = ratings.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        first = generation(batch_id, compact_every)
        if batch_id == first > 0:
            before = generation(first - 1, compact_every)
            queues = read_latest(spark, generation_path(path, before), "user_id", QUEUE_SCHEMA)
            write_batch(queues, generation_path(path, first), BEFORE_GENERATION)
            drop_folder(spark, generation_path(path, before - compact_every))
        write_batch(batch, generation_path(path, first), batch_id)

    return (recent_queue_updates(ratings, size).writeStream.outputMode("update")
            .foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(interval)).start())


def stored_queues(spark: SparkSession, path: str) -> DataFrame:
    """Every user's newest queue, ``user_id, rank, product_id, score, ts, event_id``."""
    return read_latest(spark, newest_generation(spark, path), "user_id", QUEUE_SCHEMA)
