"""Removal of long repeated strings by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too, in the same
or another document. Strings never cross documents and are judged on the input.

* **Sampled suffixes.** Every window of ``LENGTH`` bytes names one suffix, the one whose first
  ``PREFIX`` bytes hash lowest among those that start in the window early enough to lie in it;
  equal windows name the same one, so a suffix array of the named suffixes finds every repeat. A
  suffix is named by a stretch of window starts; what these windows cover is its context. It is
  kept as two fingerprints, of its first ``PREFIX`` bytes and of its context, and ordered by
  them: any order that puts equal prefixes next to one another serves a merge scan.
* **Index family.** Documents come in batches. A batch gets its sorted array of (prefix, context,
  number of places), merged at once with the levels of the index that it fills up, so a suffix is
  written again a logarithmic number of times; the array is scanned together with the levels that
  stay. A scan reports prefixes of the batch that occur twice, and whether with different contexts.
  At the end the levels tell, for these prefixes alone, the contexts that occur twice, which are
  repeated throughout; of prefixes with different contexts the others are repeated in part or not
  at all.
* **Extents.** Of the latter, one place per context is read from the text. Its windows are cut
  into cells. In a cell all windows share a core; a cell whose core is nowhere else is not
  repeated, one that is found whole twice is, and any other is cut into smaller cells, down to
  single windows. Every step counts fingerprints with map-side combining: no group of places is
  brought together, and no pairs are made. The cells of all steps are looked up in one join.

64-bit fingerprints stand for the strings, as in any hashed index: two given different strings
are taken for equal with a probability of 5e-20.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` bytes keep all; repeated rows
repeat one another; ids may be null or used twice (rows are told apart by id and text); only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.stage import written
from affinity.llm.words import Slice, mix, prefix_sums, rows_of, slices, stretch_hashes

LENGTH = 400
PREFIX = 201
WINDOW = LENGTH - PREFIX + 1
BATCHES = 4
#: Windows per cell, by step; each divides the one before, and the last is one.
CELLS = (25, 5, 1)
PIECE_BYTES = 1 << 20


def pieces(column: pa.Array) -> Iterator[tuple[int, int, Slice]]:
    """Slices of a column, and overlapping pieces of texts longer than a slice.

    Yields the first row of the slice, the place of the piece in its text, and the bytes. The
    pieces of a text share ``LENGTH - 1`` bytes, so each window is in one of them.
    """
    for part in slices(column, PIECE_BYTES):
        if len(part.data) <= 2 * PIECE_BYTES:
            yield part.start, 0, part
            continue
        for at in range(0, len(part.data) - LENGTH + 1, PIECE_BYTES):
            data = part.data[at:at + PIECE_BYTES + LENGTH - 1]
            yield part.start, at, Slice(part.start, part.stop, data, np.array([0, len(data)]))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def sampled_suffixes(part: Slice) -> tuple[np.ndarray, ...]:
    """Row, first and last window start, place, prefix and context hash of the named suffixes."""
    n = len(part.data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = prefix_sums(part.data)
    begin = np.arange(n - PREFIX + 1)
    hashes = stretch_hashes(sums, begin, begin + PREFIX)
    low = np.uint64((1 << (n - 1).bit_length()) - 1)
    named = (sliding_minimum((hashes & ~low) | begin.astype(np.uint64), WINDOW) & low).astype(np.int64)
    starts = np.arange(len(named))
    row = rows_of(starts, part.offsets)
    whole = starts + LENGTH <= part.offsets[row + 1]
    starts, named, row = starts[whole], named[whole], row[whole]
    new = np.ones(len(starts), bool)
    new[1:] = (named[1:] != named[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1] if len(at) else starts[at]
    place = named[at]
    context = mix(stretch_hashes(sums, first, last + LENGTH) + (place - first).astype(np.uint64))
    return row[at], first, last, place, hashes[place], context


def suffixes(documents: DataFrame, batches: int) -> DataFrame:
    """``doc_id, key, batch, first, last, place, prefix, context`` of all named suffixes."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start, shift, part in pieces(batch.column("text")):
                row, first, last, place, prefix, context = sampled_suffixes(part)
                base = part.offsets[row] - shift
                whose = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(whose), batch.column("key").take(whose),
                     batch.column("batch").take(whose),
                     *(pa.array((x - base).astype(np.int32)) for x in (first, last, place)),
                     *(pa.array(x.view(np.int64)) for x in (prefix, context))],
                    ["doc_id", "key", "batch", "first", "last", "place", "prefix", "context"])

    keyed = documents.select("doc_id", "text", row_key().alias("key")).withColumn(
        "batch", F.pmod(F.xxhash64("key", F.lit("batch")), F.lit(batches)).cast("int"))
    return keyed.mapInArrow(run, "doc_id long, key long, batch int, first int, last int, place int, "
                                 "prefix long, context long")


def row_key() -> Column:
    """A key that, with the id, tells rows of different texts apart."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


class SuffixIndex:
    """Levels of sorted suffix arrays ``prefix, context, n``; level k holds 2**k batches or none."""

    def __init__(self) -> None:
        self.levels: list[DataFrame | None] = []
        self.found: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Index the suffixes ``prefix, context`` of a batch and note the prefixes that repeat.

        The levels below the first empty one are merged with the batch, all in one pass, and the
        array takes that place. It is scanned together with the levels that stay.
        """
        rows, place = batch.withColumns({"n": F.lit(1), "new": F.lit(1)}), 0
        while place < len(self.levels) and self.levels[place] is not None:
            rows = rows.unionByName(self.levels[place].withColumn("new", F.lit(0)))
            self.levels[place] = None
            place += 1
        array = written(_array(rows))
        self.found.append(_scan(array, [level for level in self.levels if level is not None]))
        self.levels[place:place + 1] = [array.drop("new")]

    def repeats(self) -> DataFrame:
        """``prefix, context, whole, several``: whether the context is repeated throughout, and
        whether its prefix has other contexts too.

        All contexts of prefixes that occur twice. Those that are not repeated throughout may
        share strings with other contexts of their prefix.
        """
        found = written(reduce(DataFrame.unionByName, self.found).groupBy("prefix").agg(
            F.max("several").alias("several")))
        levels = [level for level in self.levels if level is not None]
        every = levels[0] if len(levels) == 1 else written(
            _array(reduce(DataFrame.unionByName, levels).withColumn("new", F.lit(0))))
        return every.join(found, "prefix").select("prefix", "context", (F.col("n") > 1).alias("whole"), "several")


def _array(suffixes: DataFrame) -> DataFrame:
    """A suffix array: distinct suffixes with their number of places, in order; ``new`` if any place is."""
    return (suffixes.groupBy("prefix", "context").agg(F.sum("n").cast("int").alias("n"), F.max("new").alias("new"))
            .sortWithinPartitions("prefix", "context"))


def _scan(array: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``prefix, several``: repeated prefixes of the new rows of an array, looked for in it and in the levels.

    The batch that a prefix comes with last meets all contexts of the prefix.
    """
    rows = reduce(DataFrame.unionByName, [level.withColumn("new", F.lit(0)) for level in levels], array)
    return written(rows.groupBy("prefix").agg(
        F.sum("n").alias("places"), F.max("new").alias("new"),
        (F.min("context") != F.max("context")).alias("several"))
        .where("places > 1 and new = 1").select("prefix", "several"))


def contexts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, doc_id, key, place, low, high, seen, bytes`` of the contexts that are read.

    ``low`` to ``high`` are the distances from a window's start to the suffix.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lists, texts = batch.column("places"), batch.column("text")
            for k in range(batch.num_rows):
                text = texts[k].as_buffer().to_pybytes() if texts[k].is_valid else b""
                for at in range(0, len(lists[k].values), 1024):
                    some = lists[k].values[at:at + 1024].to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(c)[k].as_py()] * len(some), pa.int64()) for c in ("doc_id", "key")]
                        + [pa.array([x[c] for x in some], pa.int32()) for c in ("first", "last", "place")]
                        + [pa.array([x["seen"] for x in some], pa.bool_()),
                           pa.array([text[x["first"]:x["last"] + LENGTH] for x in some], pa.binary())],
                        ["doc_id", "key", "first", "last", "place", "seen", "bytes"])

    listed = written(wanted.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("first", "last", "place", "seen")).alias("places")))
    found = with_key(documents, listed, "inner").select("doc_id", "key", "places", "text").mapInArrow(
        run, "doc_id long, key long, first int, last int, place int, seen boolean, bytes binary")
    return written(found.dropDuplicates(["doc_id", "key", "first", "place"]).select(
        F.monotonically_increasing_id().alias("id"), "doc_id", "key", "place",
        (F.col("place") - F.col("last")).alias("low"), (F.col("place") - F.col("first")).alias("high"),
        "seen", "bytes"))


def with_key(documents: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """``doc_id, key, text`` joined to a table of one row per ``doc_id, key``."""
    keyed = documents.select(F.col("doc_id").alias("_id"), "text", row_key().alias("_key"))
    same = F.col("_key").eqNullSafe(F.col("key")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    return keyed.join(other, same, how).drop("doc_id", "key").withColumnsRenamed({"_id": "doc_id", "_key": "key"})


def _cells(rows: DataFrame, width: int) -> DataFrame:
    """``id, seen, cell, core, whole, doc_id, key, begin, end`` of the cells of ``width`` windows in the wanted ranges.

    Input rows have ``id, doc_id, key, place, seen, low, high, bytes`` and ``begin, end``, the range
    of distances that is asked for. ``core`` is the fingerprint of what all windows of the cell
    share, ``whole`` of what those that the text has cover together, bytes ``begin`` to ``end``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("bytes")):
                rows = batch.slice(part.start, part.n_rows)
                low, high, begin, end = (rows.column(c).to_numpy().astype(np.int64)
                                         for c in ("low", "high", "begin", "end"))
                begin, end = np.maximum(low, begin), np.minimum(high, end)
                first = begin // width
                many = np.maximum(end // width - first + 1, 0)
                row = np.repeat(np.arange(part.n_rows), many)
                cell = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                place = part.offsets[row] + high[row]
                near, far = cell * width, cell * width + width - 1
                sums = prefix_sums(part.data)
                core = mix(stretch_hashes(sums, place - near, place - far + LENGTH) + cell.astype(np.uint64))
                near, far = np.maximum(near, low[row]), np.minimum(far, high[row])
                whole = mix(stretch_hashes(sums, place - far, place - near + LENGTH) + near.astype(np.uint64))
                at = pa.array(row)
                place = rows.column("place").to_numpy().astype(np.int64)[row]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id").take(at), rows.column("seen").take(at), pa.array(cell.astype(np.int32)),
                     pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)),
                     rows.column("doc_id").take(at), rows.column("key").take(at),
                     *(pa.array(x.astype(np.int32)) for x in (place - far, place - near + LENGTH))],
                    ["id", "seen", "cell", "core", "whole", "doc_id", "key", "begin", "end"])

    return rows.select("id", "doc_id", "key", "place", "seen", "low", "high", "begin", "end", "bytes").mapInArrow(
        run, "id long, seen boolean, cell int, core long, whole long, doc_id long, key long, begin int, end int")


def partial_repeats(read: DataFrame) -> DataFrame:
    """``doc_id, key, begin, end``: repeated byte ranges within the contexts that were read."""
    asked = read.withColumns({"begin": F.col("low"), "end": F.col("high")})
    unseen, repeated = [], []
    for width in CELLS:
        step = F.lit(width).alias("width")
        cells = written(_cells(asked, width))
        by_whole = written(cells.groupBy("core", "whole").agg(
            F.count("*").alias("n"), F.max("seen").alias("seen"), F.min("id").alias("id"),
            F.first("cell").alias("cell")))
        twice = F.col("seen") | (F.col("n") > 1)
        unseen.append(cells.where("not seen").select(step, "core", "whole", "doc_id", "key", "begin", "end"))
        repeated.append(by_whole.where(twice).select(step, "core", "whole"))
        if width == CELLS[-1]:
            break
        # Cells of one core that differ go on; of those found whole, one stands for all.
        open_cores = by_whole.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
        further = by_whole.join(written(open_cores), "core").select("id", twice.alias("seen"), "cell")
        asked = further.join(read.drop("seen"), "id").select(
            "id", "doc_id", "key", "place", "seen", "low", "high", (F.col("cell") * width).alias("begin"),
            (F.col("cell") * width + width - 1).alias("end"), "bytes")
    cells, whole = (reduce(DataFrame.unionByName, x) for x in (unseen, repeated))
    return cells.join(whole, ["width", "core", "whole"]).select("doc_id", "key", "begin", "end")


def repeated_ranges(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``doc_id, key, begin, end``: byte ranges that cover exactly the repeated bytes."""
    places = written(suffixes(documents, batches))
    index = SuffixIndex()
    for batch in range(batches):
        index.add(places.where(F.col("batch") == batch).select("prefix", "context"))
    marked = written(places.join(index.repeats(), ["prefix", "context"]))
    whole = marked.where("whole").select("doc_id", "key", F.col("first").alias("begin"),
                                         (F.col("last") + LENGTH).alias("end"))
    # Prefixes with several contexts: all contexts that occur once, and one place of the others.
    place = F.struct("key", "doc_id", "first", "last", "place")
    one_each = marked.where("several").groupBy("prefix", "context").agg(
        F.min(place).alias("at"), F.max("whole").alias("seen")).select("at.*", "seen")
    return whole.unionByName(partial_repeats(contexts(documents, one_each)))


def deduplicate(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``doc_id, kept, spans`` of every row: the remaining bytes and the maximal removed ranges."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            kept, spans = [], []
            for k in range(batch.num_rows):
                text = batch.column("text")[k]
                text = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged = _merged(batch.column("ranges")[k])
                spans.append(merged)
                at, parts = 0, []
                for begin, end in merged:
                    parts.append(text[at:begin])
                    at = end
                parts.append(text[at:])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()),
                 pa.array([[{"begin": a, "end": b} for a, b in one] for one in spans],
                          pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "kept", "spans"])

    return _with_ranges(documents, batches).mapInArrow(
        run, "doc_id long, kept binary, spans array<struct<begin:int,end:int>>")


def _with_ranges(documents: DataFrame, batches: int) -> DataFrame:
    listed = written(repeated_ranges(documents, batches).groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("begin", "end")).alias("ranges")))
    return with_key(documents, listed, "left").select("doc_id", "text", "ranges")


def _merged(ranges: pa.Scalar) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined, in order."""
    if not ranges.is_valid or not len(ranges.values):
        return []
    begin, end = (ranges.values.field(c).to_numpy() for c in ("begin", "end"))
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(begin)) - 1
    return list(zip(begin[new].tolist(), end[last].tolist(), strict=True))


def digests(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sizes, removed, n_spans, digest = [], [], [], []
            for k in range(batch.num_rows):
                text = batch.column("text")[k]
                text = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                merged = _merged(batch.column("ranges")[k])
                made, at = hashlib.sha256(), 0
                for begin, end in merged:
                    made.update(text[at:begin])
                    at = end
                made.update(text[at:])
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in merged))
                n_spans.append(len(merged))
                digest.append(made.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, n_spans)),
                 pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_ranges(documents, batches).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
