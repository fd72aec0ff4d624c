"""Keyed results of micro-batches, one folder per batch.

A batch writes only what it changed, and replaces its own folder when it is run
again, so a restart leaves no doubles. Reading keeps each key's newest batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: str | None = None) -> None:
    target = f"{path}/batch_id={batch_id}"
    if partition_by:
        # One folder's rows come together, but a large folder is split again.
        (df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *df.columns[:1])
         .write.mode("overwrite").partitionBy(partition_by).parquet(target))
    else:
        df.write.mode("overwrite").parquet(target)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All rows of all batches, with their ``batch_id``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).option("basePath", path).parquet(path).select(*full.names)


def read_latest(spark: SparkSession, path: str, key: str, schema: T.StructType | str) -> DataFrame:
    """The rows of each key's newest batch."""
    rows = read_batches(spark, path, schema)
    newest = rows.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, [key, "batch_id"], "left_semi").drop("batch_id")


def generation(batch_id: int, every: int) -> int:
    """The first batch of the generation that a batch belongs to: one for ``every`` batches."""
    return batch_id // every * every


def generation_path(path: str, first: int) -> str:
    return f"{path}/generation={first}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to the end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nobody reads any more; none is fine too."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def newest_generation(spark: SparkSession, path: str) -> str:
    """The folder of the newest generation that has begun."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{path}/generation=*/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    firsts = {int(f.getPath().getParent().getParent().getName().split("=")[1]) for f in found}
    return generation_path(path, max(firsts, default=0))


def compact(spark: SparkSession, path: str, target: str, key: str,
            schema: T.StructType | str) -> None:
    """Newest rows of all keys as the first batch of a fresh folder."""
    write_batch(read_latest(spark, path, key, schema), target, 0)
