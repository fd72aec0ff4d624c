"""Pairs of items that share an owner, in bounded pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import cut_lineage

CELL_ITEMS = 1024
TASK_ROWS = 20_000


def pair_tasks(rows: DataFrame) -> int:
    """Partitions for pair making, by the number of rows.

    A small input still makes many pairs, so there are at least two per core; the
    session's shuffle partitions are used as soon as the rows fill them.
    """
    spark = rows.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * spark.sparkContext.defaultParallelism,
               min(wanted, rows.count() // TASK_ROWS))


def owner_pairs(rows: DataFrame, owner: str, item: str, cell_items: int = CELL_ITEMS,
                tasks: int | None = None) -> DataFrame:
    """Every unordered pair of items of an owner, once.

    ``rows`` should be a written table: it is counted, and read for both sides.
    Other columns come back with the endings ``_a`` and ``_b``. An owner of more
    than ``cell_items`` items is split by item hash into buckets and each pair of
    buckets becomes its own join key. A row is copied once per bucket, so buckets
    grow with the root of the items: n items have at most sqrt(n) / 4 buckets and
    a cell about 16 n pairs. Other owners have a single cell.
    """
    payload = [c for c in rows.columns if c != owner]
    bucket = F.greatest(F.lit(float(cell_items)), 4 * F.sqrt("_n"))
    large = cut_lineage(
        rows.groupBy(owner).agg(F.count("*").alias("_n")).where(F.col("_n") > cell_items)
        .select(owner, F.ceil(F.col("_n") / bucket).cast("int").alias("_parts")))
    split = (rows.join(large, owner, "left")
             .withColumn("_parts", F.coalesce("_parts", F.lit(1)))
             .withColumn("_bucket", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int")))
    left = split.select(
        owner, F.col("_bucket").alias("_lo"),
        F.explode(F.sequence(F.col("_bucket"), F.col("_parts") - 1)).alias("_hi"),
        *[F.col(c).alias(f"{c}_a") for c in payload])
    right = split.select(
        owner, F.explode(F.sequence(F.lit(0), F.col("_bucket"))).alias("_lo"),
        F.col("_bucket").alias("_hi"),
        *[F.col(c).alias(f"{c}_b") for c in payload])
    # A fixed number of partitions, which the adaptive planner does not merge: it
    # would go by the bytes of the input, not by the pairs to be made of it.
    keys = [owner, "_lo", "_hi"]
    tasks = tasks or pair_tasks(rows)
    return (left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)
            .where((F.col("_lo") < F.col("_hi")) | (F.col(f"{item}_a") < F.col(f"{item}_b")))
            .drop("_lo", "_hi"))


def meeting_pairs(left: DataFrame, right: DataFrame, key: str, cell_rows: int = CELL_ITEMS,
                  tasks: int | None = None) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` that has the same key, in bounded cells.

    Both should be written tables. The rows of a large key are dealt into buckets on either side, and each
    pair of buckets is its own join key; a row is copied once per bucket of the other side.
    """
    def sizes(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(key).agg(F.ceil(F.count("*") / cell_rows).cast("int").alias(name))

    parts = cut_lineage(sizes(left, "_left").join(sizes(right, "_right"), key))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        columns = [F.col(c) for c in rows.columns]
        return (rows.join(parts, key)
                .withColumn(own, F.pmod(F.xxhash64(*columns), F.col(own)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other).cast("long") - 1))))

    keys = [key, "_left", "_right"]
    tasks = tasks or pair_tasks(left)
    return (dealt(left, "_left", "_right").repartition(tasks, *keys)
            .join(dealt(right, "_right", "_left").repartition(tasks, *keys), keys).drop("_left", "_right"))
