"""Arrow functions over all columns of a table, whatever the columns' names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from affinity.llm.words import Slice, slices

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_whole_rows(table: DataFrame, run: Batches, added: T.StructType | None = None) -> DataFrame:
    """``mapInArrow`` over all columns, with the ``added`` ones after them.

    Columns keep their names in the result; within ``run`` a name with a dot or a back-tick,
    by which ``mapInArrow`` can't find its column, is replaced.
    """
    fields = list(table.schema.fields)
    inside = [T.StructField(f"_column_{i}" if set(f.name) & set(".`") else f.name, f.dataType)
              for i, f in enumerate(fields)]
    more = list(added.fields) if added else []
    out = table.toDF(*[f.name for f in inside]).mapInArrow(run, T.StructType(inside + more))
    return out.toDF(*[f.name for f in fields + more])


def filter_by_text(table: DataFrame, keep: Callable[[Slice], np.ndarray]) -> DataFrame:
    """The rows of ``table`` for whose ``text`` ``keep``, given a slice of texts, says true."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                yield batch.slice(part.start, part.n_rows).filter(pa.array(keep(part)))

    return map_whole_rows(table, run)
