"""Benchmark decontamination: which documents contain which test items.

A short item lies in a long document if at least ``THRESHOLD`` of the item's distinct word
shingles (five words, A-Z folded) are among the document's. Jaccard similarity says little then,
so documents are partitioned by size, as in LSH Ensemble, and each partition has signatures of its
own length. A signature is one-permutation MinHash: the hash space is cut into bins and the least
shingle hash of each bin is kept. The number of bins grows with the partition's upper size bound,
so that a shingle is its bin's least with the same probability in every partition, and it is
chosen so that an item that reaches the threshold shares a bin minimum with the document with
probability ``1 - MISS`` or more, whatever the document's size: with ``s`` shared shingles at
least and ``x`` the load of a bin, ``(1 - (1 - exp(-x)) / x)**s <= MISS``. Where few shared
shingles leave no such load, the signature is all shingles. Candidates from shared minima are
then verified: the item's distinct shingles in the whole document are counted exactly. Items are
partitioned by size, too: each has the load that its own number of shingles allows, so a few short
items are searched by all shingles without a change for the long ones.

Items are the stated query set. They are searched in blocks of bounded text size, each sent to
all tasks, against all documents, and written before the next block is read; documents are never
shuffled. An item of fewer than five words is searched as one shingle of its words.

Defined cases: null or empty texts have no shingles, match nothing and, as items, are in nothing;
items without an id are searched as any other, and found with a null id; repeated rows of either table
are judged each; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.stage import written
from affinity.llm.whole_rows import filter_by_text
from affinity.llm.words import Slice, Words, shingles, slices, words

SIZE = 5
THRESHOLD = 0.8
MISS = 1e-6
#: Bytes of item text searched at once: bounds what the driver collects and each task holds.
BLOCK_BYTES = 8 << 20


def bin_load(shared: int, miss: float = MISS) -> float:
    """The largest load of a bin, among powers of two, that loses an item with ``miss`` at most."""
    for load in (1.0, 0.5, 0.25, 0.125, 0.0625):
        least = (1 - math.exp(-load)) / load
        if (1 - least) ** shared <= miss:
            return load
    return 0.0


@dataclass
class Block:
    """Items of one shingle size and load: sorted distinct shingles, and the items of each of them."""

    size: int
    found: np.ndarray
    starts: np.ndarray
    members: np.ndarray
    item_ids: pa.Array
    counts: np.ndarray
    needed: np.ndarray
    load: float

    @classmethod
    def of(cls, size: int, item_ids: pa.Array, item: np.ndarray, shingle: np.ndarray,
           threshold: float) -> list[Block]:
        """From distinct (place of the item, shingle) pairs: a block for each load that items have."""
        counts = np.bincount(item, minlength=len(item_ids))
        loads = np.array([bin_load(math.ceil(threshold * n - 1e-9)) for n in counts.tolist()])
        out = []
        for load in np.unique(loads):
            mine = np.flatnonzero(loads == load)
            ours = loads[item] == load
            out.append(cls._of(size, item_ids.take(pa.array(mine)), np.searchsorted(mine, item[ours]),
                               shingle[ours], threshold, float(load)))
        return out

    @classmethod
    def _of(cls, size: int, item_ids: pa.Array, item: np.ndarray, shingle: np.ndarray, threshold: float,
            load: float) -> Block:
        order = np.lexsort((item, shingle))
        found, starts = np.unique(shingle[order], return_index=True)
        counts = np.bincount(item, minlength=len(item_ids))
        needed = np.ceil(threshold * counts - 1e-9).astype(np.int64)
        return cls(size, found, np.append(starts, len(order)), item[order], item_ids, counts, needed, load)

    def hits(self, shingle: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) for every item that has one of the shingles, with repetitions."""
        at = np.searchsorted(self.found, shingle)
        at[at == len(self.found)] = 0
        hit = self.found[at] == shingle
        at, row = at[hit], row[hit]
        sizes = self.starts[at + 1] - self.starts[at]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(row, sizes), self.members[np.repeat(self.starts[at], sizes) + within]

    def search(self, shingle: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, ...]:
        """Rows, items and numbers of shared shingles where the threshold is reached.

        ``shingle`` holds each row's distinct shingles in ascending order.
        """
        picked = signature(shingle, row, n_rows, self.load)
        rows, items = self.hits(shingle[picked], row[picked])
        width = len(self.item_ids)
        candidates = np.unique(rows * width + items)
        if not len(candidates):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        of_candidates = np.isin(row, candidates // width)
        rows, items = self.hits(shingle[of_candidates], row[of_candidates])
        pairs, shared = np.unique(rows * width + items, return_counts=True)
        keep = np.isin(pairs, candidates) & (shared >= self.needed[pairs % width])
        return pairs[keep] // width, pairs[keep] % width, shared[keep]


def signature(shingle: np.ndarray, row: np.ndarray, n_rows: int, load: float) -> np.ndarray:
    """Which shingles are least in their bin; bins by the row's size partition and ``load``."""
    if load == 0.0 or not len(shingle):
        return np.ones(len(shingle), bool)
    counts = np.bincount(row, minlength=n_rows)
    # The partition of sizes up to 2**bits; that many bins, times the inverse of the load.
    bits = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + int(-math.log2(load))
    spot = shingle >> (64 - np.maximum(bits, 1)).astype(np.uint64)[row]
    least = np.ones(len(shingle), bool)
    least[1:] = (row[1:] != row[:-1]) | (spot[1:] != spot[:-1])
    return least


def distinct(shingle: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingles in ascending order; ``row`` is ascending."""
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    return shingle[new], row[new]


def exact_size(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of exactly ``size`` words, as the items of that few words have one."""
    shingle, row = shingles(found, 0 if not len(found.row) else int(found.row[-1]) + 1, size)
    if size == SIZE:
        return shingle, row
    counts = np.bincount(found.row)
    full = counts[row] >= size
    return shingle[full], row[full]


def item_blocks(items: list[tuple[int | None, str]], threshold: float) -> list[Block]:
    """Blocks by shingle size and load of collected items ``(item_id, text)``."""
    texts = pa.array([text for _, text in items], pa.large_string())
    ids = pa.array([i for i, _ in items], pa.int64())
    by_size: dict[int, list] = {}
    for part in slices(texts):
        found = words(part, fold=True)
        n_words = np.bincount(found.row, minlength=part.n_rows)
        for size in range(1, SIZE + 1):
            mine = np.flatnonzero(n_words >= SIZE if size == SIZE else n_words == size)
            if len(mine):
                shingle, row = distinct(*exact_size(found, size))
                ours = np.isin(row, mine)
                by_size.setdefault(size, []).append(
                    (ids[part.start:part.stop].take(pa.array(mine)), np.searchsorted(mine, row[ours]), shingle[ours]))
    out = []
    for size, found in by_size.items():
        firsts = np.cumsum([0] + [len(i) for i, _, _ in found])
        out += Block.of(size, pa.concat_arrays([i for i, _, _ in found]),
                        np.concatenate([r + f for (_, r, _), f in zip(found, firsts)]),
                        np.concatenate([s for _, _, s in found]), threshold)
    return out


def part_search(part: Slice, blocks: list[Block]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block: rows of the slice, items they contain, shared shingles; and the block."""
    found = words(part, fold=True)
    of_size = {size: distinct(*exact_size(found, size)) for size in {block.size for block in blocks}}
    for block in blocks:
        yield *block.search(*of_size[block.size], part.n_rows), block


def _search(documents: DataFrame, blocks: list[Block]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                doc_id = batch.column("doc_id")[part.start:part.stop]
                for rows, items, shared, block in part_search(part, blocks):
                    yield pa.RecordBatch.from_arrays(
                        [doc_id.take(pa.array(rows)), block.item_ids.take(pa.array(items)),
                         pa.array(block.counts[items]), pa.array(shared),
                         pa.array(shared / block.counts[items])],
                        ["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, item_id long, n_shingles long, n_shared long, containment double")


def item_search(items: DataFrame, threshold: float, block_bytes: int) -> list[Callable[[], list[Block]]]:
    """The items in groups of about ``block_bytes`` of text; each is read when it is to be searched.

    Rows are dealt out in turn, so repeated items are spread over the groups.
    """
    items = items.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(2 * total / block_bytes))
    if n_blocks > 1:
        items = written(items.repartition(n_blocks).withColumn("block", F.spark_partition_id()))

    def read(k: int) -> list[Block]:
        mine = items if n_blocks == 1 else items.where(F.col("block") == k)
        return item_blocks([(r.item_id, r.text) for r in mine.collect()], threshold)

    return [partial(read, k) for k in range(n_blocks)]


def contained_items(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of all contained items.

    One row for each row of ``documents`` and each row of ``items`` that it contains. Of several
    blocks each is written before the next is read.
    """
    first, *more = item_search(items, threshold, block_bytes)
    found = _search(documents, first())
    if not more:
        return found
    return reduce(DataFrame.unionAll, [written(_search(documents, read()) if k else found)
                                       for k, read in enumerate([first, *more])])


def drop_contaminated(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents``, all columns, whose own text contains no item.

    Of several blocks each leaves its rows written before the next is read.
    """
    def without(blocks: list[Block]) -> Callable[[Slice], np.ndarray]:
        def keep(part: Slice) -> np.ndarray:
            clean = np.ones(part.n_rows, bool)
            for rows, _, _, _ in part_search(part, blocks):
                clean[rows] = False
            return clean
        return keep

    *before, last = item_search(items, threshold, block_bytes)
    for read in before:
        documents = written(filter_by_text(documents, without(read())))
    return filter_by_text(documents, without(last()))


ORACLE_SQL = """
WITH item AS (
  SELECT item_id, row_number() OVER () AS iid,
    list_filter(regexp_split_to_array({fold_item}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
doc AS (
  SELECT doc_id, row_number() OVER () AS did,
    list_filter(regexp_split_to_array({fold_doc}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
item_shingle AS (
  SELECT DISTINCT item_id, iid, least(5, len(w)) AS size, w[i:i + least(5, len(w)) - 1] AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_shingle),
doc_shingle AS (
  SELECT DISTINCT doc_id, did, size, w[i:i + size - 1] AS s
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM doc CROSS JOIN sizes WHERE len(w) >= size)),
q AS (SELECT iid, count(*) AS n FROM item_shingle GROUP BY iid)
SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM item_shingle JOIN doc_shingle USING (size, s) JOIN q USING (iid)
GROUP BY doc_id, did, item_id, iid HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
"""


def oracle_sql() -> str:
    """The same as ``contained_items`` over the given tables, by all shingles, in SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fold = f"translate(coalesce(text, ''), '{upper}', '{lower}')"
    return ORACLE_SQL.replace("{fold_item}", fold).replace("{fold_doc}", fold)
