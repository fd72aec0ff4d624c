"""Near-duplicates: BagMinHash signatures of word-shingle multisets, bands, exact overlap.

A text is the multiset of its five-word shingles (A-Z folded); texts are linked if the weighted
Jaccard similarity of their multisets is ``THRESHOLD`` or more, and a class is what links connect.

* **Signature.** Every shingle owns a Poisson process over weight and time. Weights are
  discretised at the whole numbers and grouped hierarchically into the intervals (0,1], (1,2],
  (2,4], (4,8] ...; an interval is searched only if the shingle's weight reaches into it, its
  points come in order of time, and a point counts if its place in the interval is below the
  weight. Each point falls on one of ``SIZE`` components, which keeps its earliest point. Two
  texts keep the same point with the probability of their weighted Jaccard similarity. Points
  later than a bound, which nearly always fills all components, are not generated; a row that
  is not filled is done again with a later one.
* **Exact copies.** Texts with equal multisets (a 128-bit fingerprint) are one node from here on.
* **Bands.** ``BANDS`` bands of ``SIZE / BANDS`` components: similarity 0.8 shares none with a
  probability of 5e-8. In each bucket every node is paired with one centre, so a bucket of n
  nodes makes n - 1 pairs. Pairs whose signatures agree in too few places (four and a half
  standard errors below the threshold) end there; the others' multisets are compared exactly from the texts.
* **Cells.** Copies of one another are in one class then. What is left, pairs between classes of
  one bucket, is compared in cells of bounded size (below), so that no link of nodes that share
  a band is lost, and no row is made per pair.

Bucket centres and classes come from aggregates with map-side combining; joins with a possible hot key
read the one-row-per-key side from a written table, so that the adaptive planner can split them.

Defined cases: texts without words, null or empty, are equal to each other; fewer than five words
are one shingle; repeated rows are copies; a null id never names a class that has another id. Ids
may be null or repeat, so classes of different texts may have one ``class_id``; their nodes differ.
Other columns are not read, and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from affinity.llm.components import components
from affinity.llm.stage import written
from affinity.llm.whole_rows import map_whole_rows
from affinity.llm.words import Slice, mix, shingles, slices, words

THRESHOLD = 0.8
SIZE, BANDS = 128, 32
#: Nodes in a block of a cell, about.
CELL = 1024
#: Fewest equal components of a pair that is compared exactly.
LEAST_EQUAL = math.floor(SIZE * THRESHOLD - 4.5 * math.sqrt(SIZE * THRESHOLD * (1 - THRESHOLD)))

_STEP, _SPOT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def multisets(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, distinct shingles and their numbers of occurrences, ordered by row and shingle."""
    shingle, row = shingles(words(part, fold=True), part.n_rows)
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    first = np.flatnonzero(new)
    return row[first], shingle[first], np.diff(np.append(first, len(row)))


def fingerprints(row: np.ndarray, shingle: np.ndarray, times: np.ndarray, n_rows: int) -> np.ndarray:
    """Two 64-bit sums per row that depend on its multiset alone."""
    out = np.zeros((n_rows, 2), np.uint64)
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7)):
        part = mix(mix(shingle ^ np.uint64(salt)) + times.astype(np.uint64) * _SPOT)
        np.add.at(out[:, k], row, part)
    return out


def bag_minhash(row: np.ndarray, shingle: np.ndarray, times: np.ndarray, n_rows: int,
                size: int = SIZE) -> np.ndarray:
    """Signatures, ``size`` 16-bit components per row, of weighted shingles; zeros without any."""
    total = np.bincount(row, times, n_rows)
    signature = np.zeros((n_rows, size), np.uint16)
    open_rows, slack = total > 0, 4.0
    while open_rows.any():
        mine = open_rows[row]
        bound = np.zeros(n_rows)
        bound[open_rows] = size / total[open_rows] * (math.log(size) + slack)
        earliest, chosen = _earliest(row[mine], shingle[mine], times[mine], bound, n_rows, size)
        filled = open_rows & np.isfinite(earliest).all(1)
        signature[filled] = chosen[filled]
        open_rows &= ~filled
        slack *= 2
    return signature


def _earliest(row: np.ndarray, shingle: np.ndarray, times: np.ndarray, bound: np.ndarray, n_rows: int,
              size: int) -> tuple[np.ndarray, np.ndarray]:
    """Time and mark of the earliest point per row and component, among those before ``bound``."""
    rows, keys, low, width, weight = [], [], [], [], []
    reached, level = np.ones(len(row), bool), 0
    while reached.any():  # intervals (0,1], (1,2], (2,4], ...
        start = 0 if level == 0 else 1 << (level - 1)
        rows.append(row[reached])
        keys.append(mix(shingle[reached] + np.array([level], np.uint64) * _SPOT))
        low.append(np.full(int(reached.sum()), start))
        width.append(np.full(int(reached.sum()), max(start, 1)))
        weight.append(times[reached])
        level += 1
        reached = times > (1 << (level - 1))
    rows, keys, low, width, weight = (np.concatenate(x) for x in (rows, keys, low, width, weight))
    until = bound[rows]
    time = np.zeros(len(rows))
    earliest = np.full(n_rows * size, np.inf)
    found = []
    step = np.uint64(0)
    while len(rows):
        step += np.uint64(1)
        draw = mix(keys + np.array([step]) * _STEP)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / width
        on = time < until
        rows, keys, low, width, weight, until, time = (
            x[on] for x in (rows, keys, low, width, weight, until, time))
        spot = mix(draw[on] ^ _SPOT)
        place = low + ((spot >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 * width).astype(np.int64)
        counts = place < weight
        cell = rows[counts] * size + (spot[counts] % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, cell, time[counts])
        found.append((cell, time[counts], (spot[counts] >> np.uint64(8)).astype(np.uint16)))
    chosen = np.zeros(n_rows * size, np.uint16)
    for cell, at, mark in found:
        first = earliest[cell] == at
        chosen[cell[first]] = mark[first]
    return earliest.reshape(n_rows, size), chosen.reshape(n_rows, size)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as bytes."""
    raw = np.ascontiguousarray(rows)
    width = raw.dtype.itemsize * raw.shape[1]
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def sketches(documents: DataFrame) -> DataFrame:
    """``doc_id, node, weight, signature`` of every row; rows of one node are exact copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                row, shingle, times = multisets(part)
                n = part.n_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[part.start:part.stop], _binary(fingerprints(row, shingle, times, n)),
                     pa.array(np.bincount(row, times, n).astype(np.int64)),
                     _binary(bag_minhash(row, shingle, times, n))],
                    ["doc_id", "node", "weight", "signature"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node binary, weight long, signature binary")


def with_node(documents: DataFrame, name: str) -> DataFrame:
    """All columns of ``documents`` and the node of each row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                node = _binary(fingerprints(*multisets(part), part.n_rows))
                rows = batch.slice(part.start, part.n_rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, node], [*rows.schema.names, name])

    return map_whole_rows(documents, run, T.StructType([T.StructField(name, T.BinaryType())]))


def _handle(node: Column | str) -> Column:
    """A short key of a node for candidates; two nodes that share one are told apart later."""
    return F.xxhash64(node)


def _band_rows(nodes: DataFrame) -> DataFrame:
    """``bucket, band, handle``: one row per band of each node that has words."""
    width = 2 * SIZE // BANDS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("signature", F.lit(1) + b * width, F.lit(width))))
    return (nodes.where("weight > 0").select(F.posexplode(keys).alias("band", "bucket"), "node")
            .select("bucket", "band", _handle("node").alias("handle")))


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes ``a, b`` of paired handles whose signatures agree in ``LEAST_EQUAL`` components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                            .reshape(batch.num_rows, SIZE) for c in ("one", "two"))
                near = pa.array((one == two).sum(1) >= LEAST_EQUAL)
                yield batch.select(["a", "b"]).filter(near)

    def side(handle: str, node: str, signature: str) -> DataFrame:
        return nodes.select(_handle("node").alias(handle), F.col("node").alias(node),
                            F.col("signature").alias(signature))

    return (pairs.join(side("handle", "a", "one"), "handle").join(side("centre", "b", "two"), "centre")
            .where("a <> b").select("a", "b", "one", "two").mapInArrow(run, "a binary, b binary"))


def overlap(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets: ascending shingles, numbers of occurrences."""
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(one[1][i], two[1][j]).sum())
    whole = int(one[1].sum()) + int(two[1].sum()) - shared
    return shared / whole if whole else 1.0


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose multisets overlap enough, from the texts of their nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            nodes = batch.column("b").to_pylist()
            done = 0
            centre, of_centre = None, None
            for part in slices(batch.column("one")):
                row, shingle, times = multisets(part)
                ends = np.searchsorted(row, np.arange(part.n_rows + 1))
                for k in range(part.n_rows):
                    if nodes[done] != centre:
                        centre = nodes[done]
                        other = next(slices(batch.column("two")[done:done + 1]))
                        of_centre = multisets(other)[1:]
                    here = slice(ends[k], ends[k + 1])
                    near[done] = overlap((shingle[here], times[here]), of_centre) >= threshold - 1e-12
                    done += 1
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("one")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("two")), "b")
            .select("a", "b", "one", "two").mapInArrow(run, "a binary, b binary"))


def _texts(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text``, one text for each of the ``nodes``; copies meet before they are shuffled."""
    name = "node"
    texts = with_node(documents.select("text"), name).groupBy(name).agg(F.first("text").alias("text"))
    return written(texts.join(nodes, name, "left_semi"))


def _mixed(bands: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``bucket, band, handle, class`` of the buckets whose nodes are in several classes."""
    if labels is None:
        return bands.withColumn("class", F.col("handle"))
    classed = labels.select(_handle("node").alias("handle"), _handle("label").alias("class"))
    known = bands.join(classed, "handle", "left").select(
        "bucket", "band", "handle", F.coalesce("class", "handle").alias("class"))
    mixed = (known.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
             .where("low <> high").select("bucket"))
    return written(known.join(written(mixed), "bucket"))


def _centre_pairs(rows: DataFrame) -> DataFrame:
    """``handle, centre``: each bucket's nodes with its centre, where their classes differ."""
    order = F.struct("handle", "class")
    centres = written(rows.groupBy("bucket").agg(F.min(order).alias("c")).select(
        "bucket", F.col("c.handle").alias("centre"), F.col("c.class").alias("centre_class")))
    return (rows.join(centres, "bucket").where("class <> centre_class")
            .select("handle", "centre").distinct())


def _links_between(rows: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` that join all linked classes of a bucket, from all its pairs between classes.

    A bucket's nodes are dealt into blocks of about ``CELL``; a cell is one block or two, a task
    compares the pairs of a cell, and links alone leave it. A pair is compared in the first band
    that it shares, in order of agreeing components, and not if its classes have met by then.
    """
    sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", F.ceil(F.col("n") / CELL).cast("int").alias("blocks")))
    known = nodes.select(_handle("node").alias("handle"), "node", "signature")
    block = F.pmod(F.xxhash64("handle", F.lit("block")), F.col("blocks")).cast("int")
    cells = (rows.join(sizes, "bucket").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "band", "handle", "class", "block",
                     F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
             .join(known, "handle").join(texts, "node")
             .select("bucket", "low", "high", "band", "class", "block", "node", "signature", "text"))

    def compare(cell: pa.Table) -> pa.Table:
        band, low, high = (cell.column(c)[0].as_py() for c in ("band", "low", "high"))
        node, block = cell.column("node").to_pylist(), cell.column("block").to_numpy()
        signs = np.frombuffer(b"".join(cell.column("signature").to_pylist()), np.uint16).reshape(-1, SIZE)
        classes = cell.column("class").to_numpy()
        pairs = []
        for k in range(len(node)):
            same = signs[k + 1:] == signs[k]
            agree = same.sum(1)
            earlier = same.reshape(-1, BANDS, SIZE // BANDS).all(2)[:, :band].any(1)
            ok = (agree >= LEAST_EQUAL) & (classes[k + 1:] != classes[k]) & ~earlier
            if low != high:
                ok &= block[k + 1:] != block[k]
            at = np.flatnonzero(ok)
            pairs.append(np.stack([agree[at], np.full(len(at), k), at + k + 1]).astype(np.int32))
        pairs = np.concatenate(pairs, axis=1)
        pairs = pairs[:, np.argsort(-pairs[0], kind="stable")]
        used = np.unique(pairs[1:])
        bags = {}
        for part in slices(cell.column("text").take(pa.array(used))):
            row, shingle, times = multisets(part)
            ends = np.searchsorted(row, np.arange(part.n_rows + 1))
            for k in range(part.n_rows):
                here = slice(ends[k], ends[k + 1])
                bags[int(used[part.start + k])] = shingle[here], times[here]
        met = {int(c): int(c) for c in classes}

        def root(c: int) -> int:
            while met[c] != c:
                met[c] = met[met[c]]
                c = met[c]
            return c

        links = []
        for i, j in zip(pairs[1], pairs[2], strict=True):
            i, j = int(i), int(j)
            one, two = root(int(classes[i])), root(int(classes[j]))
            if one != two and overlap(bags[i], bags[j]) >= threshold - 1e-12:
                met[one] = two
                links.append((node[i], node[j]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.binary()),
                         "b": pa.array([x for _, x in links], pa.binary())})

    return cells.groupBy("bucket", "low", "high").applyInArrow(compare, "a binary, b binary")


def near_links(documents: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, label`` of the nodes that are linked to another, labelled by class."""
    bands = _band_rows(nodes)
    shared = written(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
    bands = written(bands.join(shared, "bucket"))
    near = bands.select("handle").distinct()
    texts = _texts(documents, nodes.join(near, _handle("node") == F.col("handle"), "left_semi").select("node"))

    def linked(pairs: DataFrame) -> DataFrame:
        return written(_verified(written(_agreeing(written(pairs), nodes)), texts, threshold))

    links = linked(_centre_pairs(_mixed(bands, None)))
    # Labels that meet early are enough here: what they leave apart is compared once more.
    rows = _mixed(bands, components(links, rounds=1))
    return components(links.union(written(_links_between(rows, nodes, texts, threshold))))


def classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, node, class_node, class_id`` of every row: its class's smallest node and smallest id."""
    sketched = written(sketches(documents))
    nodes = written(sketched.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("weight").alias("weight"),
        F.first("signature").alias("signature")))
    labels = near_links(documents, nodes, threshold)
    labelled = nodes.select("node", "first_id").join(labels, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("class_node"))
    least = labelled.groupBy("class_node").agg(F.min("first_id").alias("class_id"))
    of_node = written(labelled.join(written(least), "class_node").select("node", "class_node", "class_id"))
    return sketched.select("doc_id", "node").join(of_node, "node").select(
        "doc_id", "node", "class_node", "class_id")


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, class_key`` of every row; classes have one ``class_key`` each."""
    return classes(documents, threshold).select("doc_id", "class_id", F.hex("class_node").alias("class_key"))


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, all columns: a row with the class's smallest id.

    Rows of texts without words are one class. If several rows of a class have that id, or none has
    an id, the first by node and then by text stays.
    """
    found = written(classes(documents, threshold))
    chosen = (found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
              .groupBy("class_node").agg(F.min("class_id").alias("class_id"), F.min("node").alias("node"),
                                         F.count("*").alias("rows")))
    chosen = written(chosen)
    name = next(f"node_{i}" for i in range(len(documents.columns) + 1)
                if f"node_{i}" not in {c.lower() for c in documents.columns})
    marked = with_node(documents, name)
    same = marked["doc_id"].eqNullSafe(chosen["class_id"]) & (marked[name] == chosen["node"])
    kept = marked.join(chosen.select("class_id", "node"), same, "left_semi")
    if not chosen.where("rows > 1").isEmpty():  # ids that occur more than once
        first = Window.partitionBy("doc_id", name).orderBy("text")
        place = f"{name}_place"
        kept = kept.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    return kept.drop(name)
