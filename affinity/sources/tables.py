"""Named result tables: whole-table reads with a fixed schema, and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.topk import flatten_lists, newest_first
from affinity.schemas import ITEMCF_RECS, RATING, SCHEMAS
from affinity.sources import merged


KEPT_VERSIONS = 2
_VERSION = "version="
#: The event id of ratings that came without one: any event of the same second is newer.
NO_EVENT = -(1 << 63)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions below a table's folder that were written to the end."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{path}/{_VERSION}*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(int(f.getPath().getParent().getName().removeprefix(_VERSION)) for f in found or [])


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder of a table's newest complete version, or of a table without versions.

    Ask once per job or micro-batch: the folder then stays as it is while the table is
    replaced, until it has been replaced ``KEPT_VERSIONS`` times.
    """
    path = table_path(root, name)
    versions = _complete_versions(spark, path)
    return f"{path}/{_VERSION}{versions[-1]}" if versions else path


def has_table(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a version of the table was ever written to the end."""
    path = table_path(root, name)
    return bool(_complete_versions(spark, path)) or merged.exists(spark, path)


def rating_table(spark: SparkSession, root: str) -> merged.MergedTable:
    """The ratings with their event ids, as a table that takes changes; older than any where there is none."""
    return merged.MergedTable(
        spark, table_path(root, RATING), "user_id long, product_id long, score double, ts long, event_id long",
        ["user_id", "product_id"], newest_first(), {"event_id": F.lit(NO_EVENT)})


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               **options: str) -> DataFrame:
    """A table in its fixed schema, whatever columns or widths the files have."""
    schema = SCHEMAS[name]
    if name == RATING and merged.exists(spark, table_path(root, name)):
        raw = rating_table(spark, root).read()
    else:
        raw = _stored(spark, root, name, fmt, **options)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _stored(spark: SparkSession, root: str, name: str, fmt: str, **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(current_path(spark, root, name))


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet",
                **options: str) -> str:
    """Replace a table by a new version, which readers find when it is complete.

    The versions before it stay for those who read them, ``KEPT_VERSIONS`` of them; older
    ones are deleted. A job that fails leaves the table as it was, and ``df`` may read
    the table that is replaced. One job at a time writes a table.
    """
    spark = df.sparkSession
    path = table_path(root, name)
    schema = SCHEMAS[name]
    versions = _complete_versions(spark, path)
    target = f"{path}/{_VERSION}{versions[-1] + 1 if versions else 1}"
    (df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
     .write.mode("overwrite").format(fmt).options(**options).save(target))
    if name == RATING and merged.exists(spark, path):
        rating_table(spark, root).reset(target)
    for old in versions[:-KEPT_VERSIONS]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_VERSION}{old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return target


def write_layout(df: DataFrame, path: str, key: str, files: int | None = None) -> str:
    """Write sorted by key in key ranges, so a key filter reads few row groups.

    Range partitioning samples the key and, with the whole row order as second
    key, spreads a key that holds much of the data over several files.
    """
    rest = [c for c in df.columns if c != key]
    by = [key, *rest]
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def read_similarity(spark: SparkSession, root: str, name: str = ITEMCF_RECS) -> DataFrame:
    """Stored nested lists as long rows ``product_id, rec_id, sim``."""
    lists = read_table(spark, root, name)
    return flatten_lists(lists, "product_id", "rec_id").select(
        "product_id", "rec_id", F.col("score").alias("sim"))
