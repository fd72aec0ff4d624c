"""Text-file readers with a quarantine for rows that do not fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.scalars import to_seconds

# The product file's separator and the fields that are kept.
PRODUCT_SEPARATOR = r"\^"
PRODUCT_PARTS = 7
PRODUCT_FIELDS = {"product_id": 0, "name": 1, "image_url": 4, "categories": 5, "tags": 6}


def parse_products(lines: DataFrame) -> DataFrame:
    """Product columns plus ``reason``, which is NULL where the line is good."""
    parts = F.split("value", PRODUCT_SEPARATOR)
    cols = {name: F.trim(F.get("parts", F.lit(i))) for name, i in PRODUCT_FIELDS.items()}
    cols["product_id"] = cols["product_id"].try_cast("long")
    parsed = lines.select("value", parts.alias("parts")).select(
        *[c.alias(n) for n, c in cols.items()], F.size("parts").alias("n_parts"), "value")
    reason = (F.when(F.col("n_parts") < PRODUCT_PARTS, "too few fields")
              .when(F.col("product_id").isNull(), "bad product id")
              .when(F.col("tags") == "", "no tags"))
    return parsed.withColumn("reason", reason).drop("n_parts")


def load_products(spark: SparkSession, path: str) -> DataFrame:
    return accepted(parse_products(spark.read.text(path)))


def parse_ratings(lines: DataFrame) -> DataFrame:
    """Rating columns plus ``reason`` from comma-separated lines."""
    parts = F.split("value", ",")
    names = ("user_id", "product_id", "score", "ts")
    kinds = ("long", "long", "double", "long")
    cols = [F.trim(F.get("parts", F.lit(i))).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(zip(names, kinds))]
    parsed = lines.select("value", parts.alias("parts")).select(
        *cols, F.size("parts").alias("n_parts"), "value")
    missing = (F.col("user_id").isNull() | F.col("product_id").isNull()
               | F.col("score").isNull() | F.col("ts").isNull())
    reason = F.when(F.col("n_parts") < 4, "too few fields").when(missing, "bad field")
    return (parsed.withColumn("reason", reason).drop("n_parts")
            .withColumn("ts", to_seconds(F.col("ts"))))


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    return accepted(parse_ratings(spark.read.text(path)))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason is null").drop("reason", "value")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason is not null").select("value", "reason")


def move_files(spark: SparkSession, source: str, target: str, name: str) -> None:
    """Move the files of a written folder into another, under names that begin with ``name``.

    A file is moved as a whole. One that is there already, or a folder that is gone, is no error: a move
    that was cut short can be repeated.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern, into = hadoop.Path(f"{source}/part-*"), hadoop.Path(target)
    fs = into.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(into)
    for file in [f.getPath() for f in fs.globStatus(pattern) or []]:
        number = file.getName().split("-")[1]
        to = hadoop.Path(into, f"{name}-{number}.txt")
        if not fs.exists(to):
            fs.rename(file, to)
    fs.delete(hadoop.Path(source), True)
