"""Intermediate tables in the shared folder, without the shuffle files that made them; free column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from affinity.session import cut_lineage

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``cut_lineage``; the shuffle files of the job go when the table is written.

    Otherwise they stay until the driver's garbage is collected, and a chain of steps would hold
    the shuffles of all its steps on disk.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return cut_lineage(df)
    finally:
        conf.set(_CLEANUP, before)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or with the first number that no column has, whatever the case of its letters."""
    known = {t.lower() for t in taken}
    names = (name if k == 0 else f"{name}_{k}" for k in range(len(known) + 1))
    return next(n for n in names if n.lower() not in known)
