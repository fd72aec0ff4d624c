"""Tracking log to rating events: filter, parse, forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from affinity.functions.scalars import to_seconds
from affinity.schemas import RATING_MARKER

# Message key of forwarded events, micro-batch interval.
SINK_KEY = "logProcessor"
BATCH_INTERVAL = "2 seconds"


def stream_source(spark: SparkSession, fmt: str, schema: T.StructType | str | None = None,
                  path: str | None = None, **options: str) -> DataFrame:
    """A stream of any format; a message source gives its value as a string."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return stream.select(F.col("value").cast("string").alias("value"))
    return stream


def stream_log(spark: SparkSession, path: str, fmt: str = "text", **options: str) -> DataFrame:
    return stream_source(spark, fmt, None if fmt == "kafka" else "value string", path, **options)


def stream_ratings(spark: SparkSession, path: str, fmt: str = "text",
                   **options: str) -> DataFrame:
    """Rating events from a stream of payload lines; bad ones are left out."""
    parsed = parse_rating_event(stream_log(spark, path, fmt, **options))
    return parsed.where("reason is null").drop("reason")


def tracking_log_filter(lines: DataFrame) -> DataFrame:
    """Payload of the lines that carry the rating marker.

    The payload is what stands between the first marker and the next one.
    """
    after = F.get(F.split("value", RATING_MARKER), F.lit(1))
    return (lines.where(F.col("value").contains(RATING_MARKER))
            .withColumn("value", F.trim(after)))


def parse_rating_event(payloads: DataFrame) -> DataFrame:
    """``user|product|score|seconds`` to columns; ``reason`` is NULL on good rows."""
    parts = F.split("value", r"\|")

    def field(i: int, kind: str):
        return F.trim(F.get(parts, F.lit(i))).try_cast(kind)

    parsed = payloads.withColumns({
        "user_id": field(0, "long"), "product_id": field(1, "long"),
        "score": field(2, "double"), "ts": to_seconds(field(3, "long"))})
    missing = (F.col("user_id").isNull() | F.col("product_id").isNull()
               | F.col("score").isNull() | F.col("ts").isNull())
    reason = F.when(F.size(parts) < 4, "too few fields").when(missing, "bad field")
    return parsed.withColumn("reason", reason)


def trigger_options(interval: str | None) -> dict:
    """Micro-batches every ``interval``; without one, all there is and stop."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def log_sink(payloads: DataFrame, checkpoint: str, path: str | None = None,
             fmt: str = "parquet", interval: str | None = BATCH_INTERVAL,
             **options: str) -> StreamingQuery:
    """Forward payloads as key and value to a message topic or to files."""
    out = payloads.select(F.lit(SINK_KEY).alias("key"), "value")
    writer = (out.writeStream.format(fmt).options(**options)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(**trigger_options(interval)))
    return writer.start(path) if path else writer.start()


def stream_tracking_filter(log: DataFrame, checkpoint: str, path: str | None = None,
                           **sink: str | None) -> StreamingQuery:
    return log_sink(tracking_log_filter(log), checkpoint, path, **sink)
