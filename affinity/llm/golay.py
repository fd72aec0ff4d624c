"""Near duplicates by SimHash, found through the perfect binary Golay code.

A document's fingerprint has a bit for every bit of its shingles' hashes that is set in more than
half of them; documents are linked if their fingerprints differ in ``RADIUS`` bits or fewer.

* **Fingerprints.** Equal ones are one node from here on, however many documents have them.
* **Segments.** A fingerprint is cut into three segments of 21 or 22 bits, read as words of 23. With
  three errors in all, either one segment has none and another has one at most, or each has one.
* **Codewords.** The code has a codeword within three bits of every word. Two words one bit apart
  are nearest to the same codeword, or each is three bits from its own and four from the other's,
  for codewords differ in seven bits at least. So if every word is listed under its nearest
  codeword and, when that is three bits away, under the five that are four bits away, the first of two
  such words is listed under the second's nearest codeword.
* **Keys.** A node is listed under each pair of an exact segment and a codeword of another one; and
  under triples of codewords, the nearest one in at least one place: three of two words are
  shared if one takes all codewords of its first two segments with the nearest of its third, and the
  other the nearest of its first two with all of its third. Both kinds of triples are listed.
* **Buckets.** A key with one node is dropped. The others' nodes are dealt into blocks of about
  ``CELL`` nodes, a cell is one block or two, and a task compares the fingerprints of whole cells,
  many at once. Of what is linked in a cell only a star leaves it, so no row is made per pair.

Defined cases: A null or empty text, or one of white space, has the fingerprint zero, which links
as any other does. Fewer than three words are one shingle. A null id never names a component that has
another id; a component without any has a null. Rows are kept each, whether repeated or not. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.components import components
from affinity.llm.stage import written

RADIUS = 3
#: First bit and width of the three segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Nodes in a block of a cell, about.
CELL = 1024
#: Bytes of a text that are hashed at a time, and shingles whose bits a byte can count.
PIECE, COUNTED = 1 << 20, 255
#: The generator of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, and the hash's seed.
GENERATOR, SEED = 0b101011100011, 42

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_LANES = np.uint64(0x0101010101010101)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the three-word shingles of a text, a piece of the text at a time."""
    kept: list[bytes] = []
    any_yet, at = False, 0
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        words = kept + text[at:end].translate(_FOLD).split()
        at = end
        if len(words) >= 3:
            any_yet = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate([[0], ends[:-3] + 1])
            cuts = map(joined.__getitem__, map(slice, begins.tolist(), ends[2:].tolist()))
            yield np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(SEED)), np.uint64, len(begins))
        kept = words[-2:]
    if kept and not any_yet:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    total = np.zeros((8, 8), np.int64)  # bit within a byte, byte
    starts = np.arange(0, len(hashes), COUNTED)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        total[bit] = lanes.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return total.T.ravel()


def fingerprint(text: bytes) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        counts += bit_counts(hashes)
        n += len(hashes)
    bits = counts * 2 > n
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, node`` of every row, the fingerprint as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "node"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, node long")


def _remainder(word: int) -> int:
    """The word's remainder by the generator, as polynomials over two elements."""
    for k in range(22, 10, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - 11)
    return word


@lru_cache(maxsize=1)
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 bits and of the high 11; error patterns per remainder.

    A remainder's first pattern has three bits at most and leads to the nearest codeword. The others,
    which only remainders of three errors have, are the five of four bits; -1 where there are none.
    """
    low = np.array([_remainder(w) for w in range(1 << 12)], np.int32)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], np.int32)
    single = [_remainder(1 << k) for k in range(23)]
    errors = np.full((1 << 11, 6), -1, np.int32)
    filled = np.zeros(1 << 11, int)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            rest = 0
            for k in bits:
                rest ^= single[k]
            if weight < 4 or int(errors[rest, 0]).bit_count() == 3:
                errors[rest, filled[rest]] = sum(1 << k for k in bits)
                filled[rest] += 1
    return low, high, errors


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of each 23-bit word's near codewords, six columns, the nearest first; -1 for none."""
    low, high, errors = _code()
    pattern = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(pattern >= 0, (words[:, None] ^ pattern) >> 11, -1)


def segments(nodes: np.ndarray) -> list[np.ndarray]:
    values = nodes.view(np.uint64)
    return [((values >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64) for first, width in SEGMENTS]


def keys(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the node of each; two nodes ``RADIUS`` or fewer bits apart share one."""
    parts = segments(nodes)
    near = [codewords(p) for p in parts]
    out, rows = [], []

    def add(kind: int, value: np.ndarray, ok: np.ndarray) -> None:
        row = np.flatnonzero(ok)
        out.append(value[row] << 3 | kind)
        rows.append(row)

    for kind, (exact, other) in enumerate(permutations(range(3), 2)):
        for k in range(6):
            add(kind, parts[exact] << 12 | near[other][:, k], near[other][:, k] >= 0)
    for i in range(6):
        for j in range(6):
            a, b = near[0][:, i], near[1][:, j]
            add(6, (a << 24 | b << 12) | near[2][:, 0], (a >= 0) & (b >= 0))
    for k in range(1, 6):  # the nearest of all three is listed above
        c = near[2][:, k]
        add(6, near[0][:, 0] << 24 | near[1][:, 0] << 12 | c, c >= 0)
    return np.concatenate(out), nodes[np.concatenate(rows)]


def listed(nodes: DataFrame) -> DataFrame:
    """``key, node``: the nodes under all their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, node = keys(batch.column("node").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node)], ["key", "node"])

    return nodes.select("node").mapInArrow(run, "key long, node long")


def stars(cell: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of near nodes connect within each cell; rows are ordered by cell.

    Rows are compared with the next, the next but one, and so on as long as cells last. A near pair
    counts only while its rows have different labels, of which each row of a cell brings one at most.
    """
    n = len(cell)
    label = np.arange(n)

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    size = np.diff(np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), n))
    left = np.repeat(np.cumsum(size), size) - np.arange(n) - 1  # rows of the cell yet to come
    step = 1
    while len(row := np.flatnonzero(left >= step)):
        near = np.bitwise_count((node[row] ^ node[row + step]).view(np.uint64)) <= RADIUS
        near &= label[row] != label[row + step]
        for i in row[near].tolist():
            one, two = root(i), root(i + step)
            label[max(one, two)] = min(one, two)
        if near.any():
            while not np.array_equal(label, up := label[label]):
                label = up
        step += 1
    linked = np.flatnonzero(label != np.arange(n))
    return node[label[linked]], node[linked]


def _cell_links(cells: DataFrame) -> DataFrame:
    """``a, b`` of the stars of all cells. Rows arrive cell by cell; the last, open one waits for the next batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("key", "low", "high", "node")
        rest = [np.zeros(0, np.int64) for _ in columns]
        for batch in batches:
            if not batch.num_rows:
                continue
            key, low, high, node = (np.concatenate([r, batch.column(c).to_numpy()])
                                    for r, c in zip(rest, columns, strict=True))
            new = np.append(True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
            last = int(np.flatnonzero(new)[-1])
            rest = [x[last:] for x in (key, low, high, node)]
            yield star_batch(np.cumsum(new)[:last], node[:last])
        yield star_batch(np.zeros(len(rest[0]), np.int64), rest[3])

    def star_batch(cell: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        a, b = stars(cell, node) if len(cell) else (node, node)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    order = ["key", "low", "high"]
    return cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: nodes ``RADIUS`` or fewer bits apart, enough of them to connect all such."""
    rows = written(listed(nodes))
    sizes = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(
        "key", F.ceil(F.col("n") / CELL).cast("long").alias("blocks")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # The shared keys grow with the documents, so they are not broadcast even where they could be.
    cells = (rows.join(sizes.hint("merge"), "key").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node"))
    return written(_cell_links(cells).distinct())


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    marked = written(fingerprints(documents))
    nodes = written(marked.groupBy("node").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(nodes))
    labelled = written(nodes.join(labels, "node", "left").select(
        "node", "first_id", F.coalesce("label", "node").alias("label")))
    least = written(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")))
    of_node = written(labelled.join(least, "label").select("node", "component_id"))
    return marked.join(of_node, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
