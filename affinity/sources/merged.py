"""A table that takes changes without being rewritten: sorted runs, merged when they are read.

A change writes a run: its rows, the newest of each key, dealt into buckets by a hash of the key and
sorted within them. A manifest lists the runs; each commit creates the next manifest, which only one
writer can, so of two writers the later one reads again and goes on. Runs have levels: ``FAN`` of one
level are merged into one of the next, so a row is written again once per level. Readers take the
newest manifest, and of the rows of a key the newest.

A commit has an id; one that has been applied already adds nothing.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.topk import topk_per_key

#: Runs of a level that are merged, commit ids that are remembered, and tries of a commit.
FAN, REMEMBERED, TRIES = 8, 10_000, 50
BUCKETS = 32
_FOLDER = "manifests"
_TURN = threading.Lock()


class Conflict(Exception):
    """Another writer has created the manifest."""


def _hadoop(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _newest(spark: SparkSession, path: str) -> int:
    """The number of the newest manifest, 0 for none."""
    pattern, fs = _hadoop(spark, f"{path}/{_FOLDER}/[0-9]*")
    return max((int(f.getPath().getName()) for f in fs.globStatus(pattern) or []), default=0)


def manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest: ``runs`` (path, level) and ``commits``, oldest first."""
    number = _newest(spark, path)
    if not number:
        return 0, {"runs": [], "commits": []}
    text = spark.read.text(f"{path}/{_FOLDER}/{number:010}", wholetext=True).first().value
    return number, json.loads(text)


def exists(spark: SparkSession, path: str) -> bool:
    return _newest(spark, path) > 0


def _create(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Create a manifest: written beside and renamed, so no reader finds half of one.

    The rename fails if the manifest exists, which the file system decides for all writers. The local one
    looks first and renames then, so writers of one process take turns as well.
    """
    beside, fs = _hadoop(spark, f"{path}/{_FOLDER}/_{uuid.uuid4().hex}")
    target, _ = _hadoop(spark, f"{path}/{_FOLDER}/{number:010}")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        with _TURN:
            context.rename(beside, target, none)
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if fs.exists(target):
            raise Conflict(number) from error
        raise


def change(spark: SparkSession, path: str, edit: Callable[[dict], dict | None]) -> dict:
    """Commit ``edit`` of the newest manifest, again from the next one if another writer was first.

    ``edit`` returns the new content, or None for nothing to commit.
    """
    for _ in range(TRIES):
        number, content = manifest(spark, path)
        new = edit(content)
        if new is None:
            return content
        try:
            _create(spark, path, number + 1, new)
            return new
        except Conflict:
            continue
    raise RuntimeError(f"no commit to {path} in {TRIES} tries")


def _write_run(rows: DataFrame, path: str, keys: list[str], order: list[Column]) -> str:
    target = f"{path}/runs/{uuid.uuid4().hex}"
    newest = topk_per_key(rows, keys, order, 1).drop("rank")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("key_bucket")
    (newest.select("*", bucket).repartition("key_bucket").sortWithinPartitions("key_bucket", *keys)
     .write.partitionBy("key_bucket").parquet(target))
    return target


def _read_runs(spark: SparkSession, runs: list[dict], schema: str, keys: list[str], order: list[Column],
               missing: dict[str, Column]) -> DataFrame:
    parts = []
    for run in runs:
        rows = spark.read.parquet(run["path"])
        added = {c: v for c, v in missing.items() if c not in rows.columns}
        parts.append(rows.withColumns(added) if added else rows)
    columns = spark.createDataFrame([], schema).schema
    same = [p.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns]) for p in parts]
    if not same:
        return spark.createDataFrame([], schema)
    return topk_per_key(reduce(DataFrame.unionAll, same), keys, order, 1).drop("rank")


class MergedTable:
    """A table with a key and an order of its rows, the newest first, below a folder.

    ``missing`` gives columns that runs written elsewhere may lack.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], order: list[Column],
                 missing: dict[str, Column] | None = None) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.missing = keys, order, missing or {}

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._of(manifest(self.spark, self.path)[1]["runs"])

    def _of(self, runs: list[dict]) -> DataFrame:
        return _read_runs(self.spark, runs, self.schema, self.keys, self.order, self.missing)

    def reset(self, base: str | None) -> None:
        """Start again from a table written elsewhere, or from nothing."""
        runs = [{"path": base, "level": 99}] if base else []
        change(self.spark, self.path, lambda old: {"runs": runs, "commits": old["commits"]})

    def applied(self, commit: str) -> bool:
        return commit in manifest(self.spark, self.path)[1]["commits"]

    def add(self, rows: DataFrame, commit: str) -> bool:
        """Add the rows of a commit; False if it was applied before, by whomever."""
        if self.applied(commit):
            return False
        run = {"path": _write_run(rows, self.path, self.keys, self.order), "level": 0}
        added = []

        def edit(old: dict) -> dict | None:
            added.clear()
            if commit in old["commits"]:
                return None
            added.append(commit)
            return {"runs": [*old["runs"], run], "commits": [*old["commits"], commit][-REMEMBERED:]}

        change(self.spark, self.path, edit)
        if added:
            self.compact()
        return bool(added)

    def compact(self) -> None:
        """Merge the runs of each level that has ``FAN``, from the lowest up; levels that another merges wait."""
        while True:
            runs = manifest(self.spark, self.path)[1]["runs"]
            levels = [r["level"] for r in runs]
            full = next((level for level in sorted(set(levels)) if levels.count(level) >= FAN), None)
            if full is None:
                return
            mine = [r for r in runs if r["level"] == full]
            merged = {"path": _write_run(self._of(mine), self.path, self.keys, self.order), "level": full + 1}

            def edit(old: dict, mine: list[dict] = mine, merged: dict = merged) -> dict | None:
                if any(r not in old["runs"] for r in mine):
                    return None  # merged by another writer
                return {**old, "runs": [merged, *[r for r in old["runs"] if r not in mine]]}

            change(self.spark, self.path, edit)
