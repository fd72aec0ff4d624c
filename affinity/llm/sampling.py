"""Labelled rows: the fixed fold that is held out, and a bounded sample to learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinity.llm.stage import written

#: Bytes of text that a sample has at most, whatever the number of its rows.
SAMPLE_BYTES = 128 << 20


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """The remainder of crc32 of the id's decimal text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string")) % folds


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, folds: int,
                    held_out: int, bound: int) -> DataFrame:
    """At most ``bound`` labelled texts outside the held-out fold: ``doc_id, y, text``.

    The ids with the smallest hashes are taken, so the sample does not depend on the order of the
    tables. A document labelled more than once has its largest label, an id of several rows its first text
    in order, so the bound is one of rows. Of these rows those count, in order of the hashes, whose
    texts are ``SAMPLE_BYTES`` together. The sampled ids, ``bound`` at most, are broadcast to the scan of the texts.
    """
    picked = (labels.select("doc_id", F.col(label).alias("y"))
              .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull()
                     & (fold_of("doc_id", folds) != held_out))
              .groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    texts = (documents.select("doc_id", "text")
            .join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
                F.max("y").alias("y"), F.min("text").alias("text")))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = written(texts.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0))))
    few = sizes.select("doc_id", F.sum("bytes").over(so_far).alias("total")).where(F.col("total") <= SAMPLE_BYTES)
    # As many rows as the bound says, and ids alone.
    return sizes.join(F.broadcast(few), "doc_id").select("doc_id", "y", "text")


def collect_features(sample: DataFrame, extract: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                     schema: str) -> pa.Table:
    """Feature arrays of a bounded sample, extracted on the executors, in order of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from extract(batch)

    return sample.mapInArrow(run, schema).toArrow().sort_by("doc_id")
