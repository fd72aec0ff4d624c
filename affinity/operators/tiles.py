"""Products of all rows of a sparse matrix, tile by tile.

The rows (items) are dealt into tiles and the columns (users) into blocks. A task has two tiles
under one block of columns, multiplies them as dense matrices and returns the cells that are not
zero; with several blocks the cells are summed by their keys. A row is copied once per tile, and
no pair is formed for a user: cells of many users with few items in common are what it saves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of a tile and columns of a block, about, and the entries that a tile may have.
TILE_ITEMS, BLOCK_COLUMNS, TILE_ENTRIES = 1024, 4096, 4_000_000


def tiles_for(items: int, entries: int) -> int:
    return max(1, math.ceil(items / TILE_ITEMS), math.ceil(entries / TILE_ENTRIES))


def _pair_cells(entries: DataFrame, tiles: int) -> DataFrame:
    """``low, high, tile`` and the entries, once for every cell of two tiles that an item's tile is in."""
    return (entries.withColumn("tile", F.pmod(F.xxhash64("item"), F.lit(tiles)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
            .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("other"))


def nearest_rows(entries: DataFrame, tiles: int, k: int, least: float, scale: float) -> DataFrame:
    """``a, b, sim``: for every item the ``k`` others, and itself, with the largest products above ``least``.

    ``entries`` are ``item, col, w``. Products that are equal times ``scale``, as whole numbers, are ranked by
    item. A cell passes on ``k`` rows per item, so there are k per item and tile. Columns are taken in
    blocks of ``BLOCK_COLUMNS``, so a cell holds its entries, two dense blocks and its products.
    """
    block_columns = BLOCK_COLUMNS

    def cell(table: pa.Table) -> pa.Table:
        tile, item, col, w = (table.column(c).to_numpy() for c in ("tile", "item", "col", "w"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        columns, place = np.unique(col, return_inverse=True)
        sides = []
        for which in dict.fromkeys((low, high)):
            mine = np.flatnonzero(tile == which)
            mine = mine[np.argsort(place[mine], kind="stable")]
            names, row = np.unique(item[mine], return_inverse=True)
            sides.append((names, row, place[mine], w[mine]))
        sums = np.zeros((len(sides[0][0]), len(sides[-1][0])))
        for first in range(0, len(columns), block_columns):
            blocks = []
            for names, row, at, value in sides:
                here = slice(*np.searchsorted(at, [first, first + block_columns]))
                dense = np.zeros((len(names), min(block_columns, len(columns) - first)))
                dense[row[here], at[here] - first] = value[here]
                blocks.append(dense)
            sums += blocks[0] @ blocks[-1].T
        out = ([], [], [])
        for names, others, of in ((sides[0][0], sides[-1][0], sums), (sides[-1][0], sides[0][0], sums.T))[:len(sides)]:
            if not of.size:
                continue
            # Equal products are ranked by item, and items ascend.
            best = np.argsort(-np.round(of * scale), axis=1, kind="stable")[:, :k + 1]
            value = np.take_along_axis(of, best, 1)
            r, c = np.nonzero(value > least)
            for x, found in zip(out, (names[r], others[best[r, c]], value[r, c]), strict=True):
                x.append(found)
        a, b, sim = (np.concatenate(x) if x else np.zeros(0) for x in out)
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64)), "sim": pa.array(sim)})

    return _pair_cells(entries, tiles).groupBy("low", "high").applyInArrow(cell, "a long, b long, sim double")


def row_products(entries: DataFrame, tiles: int, blocks: int) -> DataFrame:
    """``a, b, co``: the sum of ``n_a * n_b`` over the columns that two items share, where not zero.

    ``entries`` are ``item, col, n`` with one row per item and column. Both directions of a pair
    are given, and every item with itself. Sums are exact in whole numbers.
    """
    dealt = _pair_cells(entries.withColumn("block", F.pmod(F.xxhash64("col"), F.lit(blocks)).cast("int")), tiles)

    def product(cell: pa.Table) -> pa.Table:
        tile, item, col, n = (cell.column(c).to_numpy() for c in ("tile", "item", "col", "n"))
        low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
        columns, place = np.unique(col, return_inverse=True)
        exact = int(np.abs(n).max()) ** 2 * len(columns) < 1 << 53

        def dense(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            names, row = np.unique(item[which], return_inverse=True)
            out = np.zeros((len(names), len(columns)), np.float64 if exact else np.int64)
            out[row, place[which]] = n[which]
            return names, out

        one, left = dense(tile == low)
        two, right = (one, left) if low == high else dense(tile == high)
        sums = left @ right.T
        i, j = np.nonzero(sums)
        co = sums[i, j].astype(np.int64)
        a, b = one[i], two[j]
        if low != high:
            a, b, co = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([co, co])
        return pa.table({"a": a, "b": b, "co": co})

    cells = dealt.groupBy("block", "low", "high").applyInArrow(product, "a long, b long, co long")
    return cells if blocks == 1 else cells.groupBy("a", "b").agg(F.sum("co").alias("co"))
