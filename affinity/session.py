"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "affinity", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    cpus = cpus or os.cpu_count() or 4
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master that names none; on a
    cluster a missing setting is an error, since no machine-local folder would do.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir())
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="affinity-")
    spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet.

    All paths of one application share a folder, which can go when it has ended.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark).rstrip('/')}/affinity/{app}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written files.

    For results that several later steps read: they survive the loss of
    executors and are not computed again.

    Also for the one-row-per-key side of a join whose other side may be skewed.
    The adaptive planner splits a hot key only where both sides come straight from
    their own shuffles, which an aggregate on the join key does not; and it
    broadcasts a side only if it knows it to be small, which it does for files.

    The shuffle files of the write go when it has ended: nothing but the written files is read again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "stage")
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Within, the adaptive planner sorts neither side of a join of which all partitions of one side are small."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``cut_lineage`` gave and that nothing reads any more."""
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
