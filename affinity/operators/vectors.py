"""Cosine similarity of dense vectors, block against block, without the blocks that can't matter.

Vectors are dealt to the nearest of some pivots. The angle between two vectors is at least the angle
from one of them to the other's pivot, less the other's own angle to that pivot. So a vector goes
to the blocks of a pivot only if that leaves an angle within the threshold, or within reach of
somebody's k-th best so far; what does not go is not shipped, and the result is that of all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.topk import topk_per_key
from affinity.schemas import SIM_THRESHOLD
from affinity.session import cut_lineage

MIN_BLOCK_ROWS = 256
MAX_BLOCK_ROWS = 8192
TILE_ROWS = 512
#: Most pivots, the vectors that they are chosen from per pivot, and the most numbers these may have.
MAX_PIVOTS, SAMPLE_PER_PIVOT, SAMPLE_NUMBERS = 2048, 16, 8_000_000
# More than single-precision cosines of unit vectors can be off.
SINGLE_SLACK = 1e-4
# More than computed angles can be off.
ANGLE_SLACK = 1e-6


def block_count(rows: int, parallelism: int) -> int:
    """Blocks so that the cells keep all cores busy and a block stays in memory."""
    wanted = math.ceil(math.sqrt(6 * parallelism))
    size = min(max(rows // wanted, MIN_BLOCK_ROWS), MAX_BLOCK_ROWS)
    return max(1, math.ceil(rows / size))


def _pivots(rows: DataFrame, wanted: int, length: int) -> np.ndarray:
    """Unit vectors far from each other, from a sample of bounded size that depends on the ids alone.

    The first is the sample's first, each next one the vector farthest from all before.
    """
    bound = max(wanted, min(SAMPLE_PER_PIVOT * wanted, SAMPLE_NUMBERS // max(length, 1)))
    table = rows.orderBy(F.xxhash64("id"), "id").limit(bound).select("v").toArrow()
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(table.num_rows, -1).astype(np.float64)
    norms = np.linalg.norm(vectors, axis=1)
    vectors = vectors[norms > 0] / norms[norms > 0, None]
    if not len(vectors):
        return vectors
    chosen, near = [0], vectors @ vectors[0]
    while len(chosen) < wanted and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    return vectors[chosen]


def _placed(rows: DataFrame, pivots: np.ndarray, blocks_rows: int) -> tuple[DataFrame, DataFrame]:
    """``id, v, pivot, angle, part`` of the vectors that are not zero, written; and rows per pivot."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(batch.num_rows, -1).astype(np.float64)
            norms = np.linalg.norm(vectors, axis=1)
            kept = np.flatnonzero(norms > 0)
            cosines = (vectors[kept] / norms[kept, None]) @ pivots.T
            nearest = cosines.argmax(1)
            angle = np.arccos(np.clip(cosines[np.arange(len(kept)), nearest], -1, 1))
            some = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), some.column("v"), pa.array(nearest.astype(np.int32)), pa.array(angle)],
                names=["id", "v", "pivot", "angle"])

    kind = rows.schema["v"].dataType.simpleString()
    near = cut_lineage(rows.mapInArrow(assign, f"id long, v {kind}, pivot int, angle double"))
    parts = cut_lineage(near.groupBy("pivot").agg(F.count("*").alias("n")).select(
        "pivot", F.ceil(F.col("n") / blocks_rows).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int").alias("part")
    # One row per pivot.
    return near.join(F.broadcast(parts), "pivot").select("id", "v", "pivot", "angle", part), parts


def shipped(placed: DataFrame, parts: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``lo, hi, block, id, v, least``: every vector for every cell that it may have a partner in.

    ``placed`` has ``least`` with the cosine that each vector looks for. Block numbers are
    those of the pivots, then those of their parts.
    """
    wide = F.col("angle") + F.acos("least")
    reach = {r.pivot: (r.radius, r.reach) for r in placed.groupBy("pivot").agg(
        F.max("angle").alias("radius"), F.max(wide).alias("reach")).collect()}  # one row per pivot
    radius, far = (np.array([reach.get(p, (-10.0, -10.0))[i] for p in range(len(pivots))]) for i in (0, 1))
    slack = ANGLE_SLACK

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(batch.num_rows, -1).astype(np.float64)
            vectors /= np.linalg.norm(vectors, axis=1)[:, None]
            angles = np.arccos(np.clip(vectors @ pivots.T, -1, 1))
            seeks = np.arccos(np.clip(batch.column("least").to_numpy(), -1, 1))
            go = angles <= np.maximum(far, seeks[:, None] + radius) + slack
            go[np.arange(len(go)), batch.column("pivot").to_numpy()] = True
            row, pivot = np.nonzero(go)
            ends = np.append(0, np.cumsum(go.sum(1))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(pivot.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "others"])

    kind = placed.schema["v"].dataType.simpleString()
    found = placed.select("id", "v", "pivot", "part", "least").mapInArrow(
        targets, f"id long, v {kind}, pivot int, part int, least double, others array<int>")
    number = F.shiftleft(F.col("pivot").cast("long"), 32)
    other = F.shiftleft(F.col("other").cast("long"), 32)
    every = parts.select(F.col("pivot").alias("other"), F.col("parts").alias("other_parts"))
    return (found.withColumn("other", F.explode("others")).join(F.broadcast(every), "other")
            .withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
            .withColumns({"block": number + F.col("part"), "other": other + F.col("other_part")})
            .select(F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                    "block", "id", "v", "least"))


def dense_cosine_pairs(items: DataFrame, threshold: float = SIM_THRESHOLD,
                       id_col: str = "product_id", vector_col: str = "features",
                       blocks: int | None = None, k: int | None = None) -> DataFrame:
    """All ordered pairs of different items with cosine above the threshold.

    With ``k``, only pairs that may be among an item's ``k`` most similar leave a cell. Pairs
    within blocks come first; an item with k of them looks for no less than its k-th best elsewhere,
    and goes to the blocks where that may be found or where somebody may look for it.

    A block is what is nearest to a pivot, in parts of bounded size, and a cell is one or two of
    them: one matrix product, from which only pairs that pass leave the worker, a tile at a time.
    Zero vectors give no pairs.
    """
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("long").alias("id"),
                        F.col(vector_col).alias("v")).where("v is not null")
    count, least, most, holes = rows.agg(
        F.count("*"), F.min(F.size("v")), F.max(F.size("v")),
        F.count_if(F.exists("v", lambda x: x.isNull()))).first()
    if least != most or holes:
        raise ValueError(f"vectors of one length without nulls are needed: lengths {least} to "
                         f"{most}, {holes} with nulls")
    blocks = blocks or block_count(count, spark.sparkContext.defaultParallelism)
    pivots = _pivots(rows, min(blocks, MAX_PIVOTS), most or 0) if count else np.zeros((0, 0))
    if not len(pivots):
        hits = spark.createDataFrame([], "a long, b long, sim double")
    else:
        placed, parts = _placed(rows, pivots, max(MIN_BLOCK_ROWS, min(MAX_BLOCK_ROWS, math.ceil(count / blocks))))
        plain = placed.withColumn("least", F.lit(float(threshold)))
        if k is None:
            hits = _cell_hits(shipped(plain, parts, pivots), threshold, None)
        else:
            hits = _best_hits(plain, parts, pivots, threshold, k)
    return hits.select(F.col("a").alias(id_col), F.col("b").alias("rec_id"), "sim")


def _best_hits(placed: DataFrame, parts: DataFrame, pivots: np.ndarray, threshold: float, k: int) -> DataFrame:
    """Hits within blocks, and those elsewhere that may better somebody's first ``k``."""
    number = F.shiftleft(F.col("pivot").cast("long"), 32) + F.col("part")
    own = placed.select(number.alias("lo"), number.alias("hi"), number.alias("block"), "id", "v", "least")
    within = cut_lineage(_cell_hits(own, threshold, k))
    worst = cut_lineage(within.groupBy(F.col("a").alias("id")).agg(
        F.count("*").alias("n"), F.min("sim").alias("kth")).where(F.col("n") >= k).select("id", "kth"))
    # A hair less than the k-th best: equal cosines are ranked by id.
    held = cut_lineage(placed.drop("least").join(worst, "id", "left").withColumn(
        "least", F.coalesce(F.greatest(F.lit(float(threshold)), F.col("kth") - 2e-9), F.lit(float(threshold))))
        .drop("kth"))
    elsewhere = shipped(held, parts, pivots).where("lo <> hi")
    return within.unionByName(_cell_hits(elsewhere, threshold, k))


def _cell_hits(cells: DataFrame, threshold: float, k: int | None) -> DataFrame:
    """``a, b, sim`` of the pairs of two blocks, or of one, that are near enough."""
    tile_rows, slack = TILE_ROWS, SINGLE_SLACK

    # The function stands by itself, so workers need no copy of this package.
    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        low, high = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        least = table.column("least").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        unit = flat.reshape(len(ids), -1).astype(np.float64)
        unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
        single = unit.astype(np.float32)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for start in range(0, len(left), tile_rows):
            tile = left[start:start + tile_rows]
            # Single precision finds what may pass, double precision decides.
            rough = single[tile] @ single[right].T
            lowest = np.minimum(least[tile][:, None], least[right]) if k is not None else threshold
            r, c = np.nonzero(rough > lowest - slack)
            if 20 * len(r) > rough.size:
                sim = (unit[tile] @ unit[right].T)[r, c]
            else:
                sim = np.einsum("ij,ij->i", unit[tile[r]], unit[right[c]])
            a, b, seeks = ids[tile[r]], ids[right[c]], least[tile[r]]
            keep = (sim > threshold) & (a != b)
            a, b, sim, seeks, sought = a[keep], b[keep], sim[keep], seeks[keep], least[right[c[keep]]]
            if low != high:
                a, b, sim = np.append(a, b), np.append(b, a), np.append(sim, sim)
                seeks = np.append(seeks, sought)
            if k is not None:
                worth = sim >= seeks
                a, b, sim = a[worth], b[worth], sim[worth]
                order = np.lexsort((b, -np.round(sim, 9), a))
                a, b, sim = a[order], b[order], sim[order]
                first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else order
                place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
                a, b, sim = a[place < k], b[place < k], sim[place < k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())],
                names=["a", "b", "sim"])

    return cells.groupBy("lo", "hi").applyInArrow(cell, "a long, b long, sim double")


def ranked_pairs(pairs: DataFrame, id_col: str = "product_id", k: int | None = None) -> DataFrame:
    """Similarity lists, most similar first; uncapped unless ``k`` is given."""
    alike = F.round(F.col("sim"), 9)
    return topk_per_key(pairs, id_col, [F.desc(alike), F.asc("rec_id")], k)
