"""Item-to-item similarity from co-ratings.

``sim(a, b) = co(a, b) / sqrt(count(a) * count(b))`` where ``co`` counts pairs of
rating rows of one user on the two products. Rows are first combined to one row
per user and product with its multiplicity, so repeated ratings never multiply.

The ranking inside a product's list is by ``co^2 / count`` of the other product.
That is the same order as by similarity, but mathematically equal values are
equal as floating-point numbers too, so ties always fall back to the product id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.scalars import cooccurrence_sim
from affinity.operators.pairs import CELL_ITEMS, owner_pairs, pair_tasks
from affinity.operators.tiles import BLOCK_COLUMNS, row_products, tiles_for
from affinity.operators.topk import ranked_lists, topk_per_key, topk_to_depth
from affinity.schemas import LIST_SIZE
from affinity.session import cut_lineage, discard

HEAVY_ITEMS = 2048
#: Summed pairs of a list's owner that one task ranks, about.
CELL_PAIRS = 1_000_000
#: Pairs that a round forms: so many for each row of the table, and at least so many in all. Fewer take one plan.
ROUND_PAIRS, LEAST_ROUND = 8, 10_000_000
#: Pairs of one user that take the work of one lookup, about.
LOOKUP_PAIRS = 8


def user_items(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """One row per user and product: multiplicity ``n`` and the product's count ``size``.

    The combined rows are written at once; all that follows reads that compact
    table and the ratings never again.
    """
    n = F.lit(1).cast("long") if dedup else F.count("*")
    rows = cut_lineage(ratings.groupBy("user_id", "product_id").agg(n.alias("n")))
    sizes = cut_lineage(rows.groupBy("product_id").agg(F.sum("n").alias("size")))
    sized = cut_lineage(rows.join(sizes, "product_id")
                        .select("user_id", "product_id", "n", "size"))
    for table in (rows, sizes):
        discard(table)
    return sized


def pair_counts(rows: DataFrame, cell_items: int = CELL_ITEMS,
                of_product: tuple[str, ...] = ("size",)) -> DataFrame:
    """Co-rating counts of unordered pairs ``a < b`` from ``user_items`` rows.

    Half of the pairs are enough: the measure is symmetric, and mirroring after
    the aggregation halves the shuffle. ``of_product`` names columns that depend
    on the product alone; they come along for both ends of a pair.
    """
    a, b = F.col("product_id_a"), F.col("product_id_b")
    ends = [(f"{c}_{end}", f"{c}_{other}") for c in of_product for end, other in ("ab", "ba")]
    pairs = owner_pairs(rows, "user_id", "product_id", cell_items).select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
        (F.col("n_a") * F.col("n_b")).alias("co"),
        *[F.when(a < b, F.col(end)).otherwise(F.col(other)).alias(end) for end, other in ends])
    return pairs.groupBy("a", "b").agg(
        F.sum("co").alias("co"), *[F.max(end).alias(end) for end, _ in ends])


def mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of every unordered pair, in one pass over the input."""
    cols = ("a", "b", "co", "size_a", "size_b")
    return pairs.select(F.stack(
        F.lit(2), *[F.col(c) for c in cols],
        *[F.col(c) for c in ("b", "a", "co", "size_b", "size_a")]).alias(*cols))


def itemcf_pairs(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """All ordered product pairs with their counts and similarity."""
    both = mirrored(pair_counts(user_items(ratings, dedup)))
    return both.select(
        F.col("a").alias("product_id"), F.col("b").alias("rec_id"),
        F.col("co").alias("co_count"), F.col("size_a").alias("count1"),
        F.col("size_b").alias("count2"),
        cooccurrence_sim(F.col("co"), F.col("size_a"), F.col("size_b")).alias("sim"))


def _strength(co: str, size: str) -> Column:
    return F.col(co).cast("double") * F.col(co) / F.col(size)


def _strongest() -> list[Column]:
    return [F.desc(_strength("co", "size_b")), F.asc("b")]


def _first(both: DataFrame, k: int) -> DataFrame:
    return topk_per_key(both, "a", _strongest(), k)


def _listed(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        F.col("a").alias("product_id"), "rank", F.col("b").alias("rec_id"),
        cooccurrence_sim(F.col("co"), F.col("size_a"), F.col("size_b")).alias("sim"))


def _top(both: DataFrame, k: int) -> DataFrame:
    return _listed(_first(both, k))


def heavy_users(rows: DataFrame, min_items: int = HEAVY_ITEMS) -> DataFrame:
    """``user_id`` of the users with more than ``min_items`` products, written."""
    return cut_lineage(rows.groupBy("user_id").agg(F.count("*").alias("items"))
                       .where(F.col("items") > min_items).select("user_id"))


def itemcf_topk(ratings: DataFrame, k: int = LIST_SIZE, dedup: bool = False,
                min_heavy_items: int = HEAVY_ITEMS, cell_items: int = CELL_ITEMS) -> DataFrame:
    """The ``k`` most similar products of every product: exact, whatever the skew.

    A user with d products has d^2 pairs. For the users where that would
    dominate, pairs of like products are formed instead: see ``_with_heavy``.
    """
    rows = user_items(ratings, dedup)
    heavy = heavy_users(rows, min_heavy_items)
    if heavy.isEmpty() and not _forms_few(rows):
        return _listed(_owner_rounds(rows, k, _ranked_cells, cell_items=cell_items, best=True))
    both = (mirrored(pair_counts(rows, cell_items)) if heavy.isEmpty()
            else _with_heavy(rows, heavy, k, cell_items))
    return _top(both, k)


def lists_to_depth(rows: DataFrame, depths: DataFrame, min_heavy_items: int = HEAVY_ITEMS,
                   cell_items: int = CELL_ITEMS) -> DataFrame:
    """What ``itemcf_topk`` gives, for the products of ``depths`` only and to their own depths.

    ``rows`` are ``user_items`` rows, ``depths`` a written table ``product_id, depth``. Only pairs
    whose first product has a list are formed and summed, and a list's depth is with its pairs
    from the start, so a deep list costs nothing to the others.
    """
    heavy = heavy_users(rows, min_heavy_items)
    if heavy.isEmpty() and _forms_few(rows):
        return _listed(_ranked_to_depth(_owner_pair_counts(rows, depths)))
    if heavy.isEmpty():
        return _listed(_owner_rounds(rows, depths, _ranked_cells, cell_items=cell_items, best=True))
    return _listed(_ranked_to_depth(_with_heavy(rows, heavy, None, cell_items, depths)))


def _owner_pair_counts(rows: DataFrame, depths: DataFrame,
                       of_product: tuple[str, ...] = ("size",)) -> DataFrame:
    """Co-rating counts of ordered pairs ``a, b`` where ``a`` has a list, dealt out by ``a, cell``.

    The lists' owners meet the ratings before pairs are made. A product's pairs are cut into cells
    by how many its users will form. Where pairs repeat a lot they are summed before they
    are dealt out as well.
    """
    degrees = cut_lineage(rows.groupBy("user_id").agg(F.count("*").alias("degree")))
    owned = rows.join(depths, "product_id")
    formed = cut_lineage(owned.join(degrees, "user_id").groupBy("product_id").agg(
        F.sum("degree").alias("formed"), F.max("depth").alias("depth")))
    total, owners = formed.agg(F.sum("formed"), F.count("*")).first()
    products = rows.agg(F.count_distinct("product_id")).first()[0]
    lists = formed.select("product_id", "depth",
                          F.ceil(F.col("formed") / CELL_PAIRS).cast("int").alias("parts"))
    tasks = pair_tasks(rows)
    left = rows.join(lists, "product_id").select(
        "user_id", "depth", "parts", F.col("product_id").alias("a"), F.col("n").alias("n_a"),
        *[F.col(c).alias(f"{c}_a") for c in of_product])
    right = rows.select("user_id", F.col("product_id").alias("b"), F.col("n").alias("n_b"),
                        *[F.col(c).alias(f"{c}_b") for c in of_product])
    of_pair = ["depth", "parts", *[f"{c}_{end}" for c in of_product for end in "ab"]]

    def summed(pairs: DataFrame, *keys: str) -> DataFrame:
        return pairs.groupBy(*keys).agg(F.sum("co").alias("co"), *[F.max(c).alias(c) for c in of_pair])

    pairs = (left.repartition(tasks, "user_id").join(right.repartition(tasks, "user_id"), "user_id")
             .where("a <> b").select("a", "b", (F.col("n_a") * F.col("n_b")).alias("co"), *of_pair))
    if (total or 0) > 4 * owners * products:
        pairs = summed(pairs, "a", "b")
    cell = F.pmod(F.xxhash64("b"), F.col("parts")).alias("cell")
    return summed(pairs.withColumn("cell", cell).repartition(tasks, "a", "cell"), "a", "cell", "b")


def _forms_few(rows: DataFrame) -> bool:
    """Whether the users' pairs are few enough to be counted as one plan."""
    per_user = rows.groupBy("user_id").agg(F.count("*").cast("double").alias("d"))
    return (per_user.agg(F.sum(F.col("d") * F.col("d"))).first()[0] or 0) <= LEAST_ROUND


def _whole_type(least: int, most: int) -> str:
    """The smallest type of whole numbers that holds both."""
    return str(np.result_type(np.min_scalar_type(min(least, 0)), np.min_scalar_type(max(most, 0))))


def _types(rows: DataFrame) -> dict[str, str]:
    """Of a list's columns ``b``, ``n`` and ``size``, the types that hold all their values."""
    bounds = rows.agg(*[f(c).alias(f"{name}_{c}") for c in ("product_id", "n", "size")
                        for name, f in (("least", F.min), ("most", F.max))]).first()
    found = {c: (bounds[f"least_{c}"] or 0, bounds[f"most_{c}"] or 0) for c in ("product_id", "n", "size")}
    kinds = {c: _whole_type(*pair) for c, pair in found.items()}
    # Values of both signs beyond 32 bits have no common type but a fraction.
    return {name: "int64" if "float" in kinds[c] or kinds[c] == "uint64" else kinds[c]
            for name, c in (("b", "product_id"), ("n", "n"), ("size", "size"))}


def _packer(types: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Makes a list of each ``user_id, chunk`` of a partition: its columns as bytes, and the owners among its products."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches)
        user, chunk, b, n, size, depth = (whole.column(c).to_numpy() for c in (
            "user_id", "chunk", "b", "n", "size", "depth"))
        order = np.lexsort((chunk, user)) if (chunk > 0).any() else np.argsort(user, kind="stable")
        user, chunk, b, n, size, depth = (x[order] for x in (user, chunk, b, n, size, depth))
        begins = np.flatnonzero(np.append(True, (np.diff(user) != 0) | (np.diff(chunk) != 0)))
        for first in range(0, len(begins), 4096):
            ends = np.append(begins, len(user))[first:first + 4097]
            here = slice(ends[0], ends[-1])
            mine = np.flatnonzero(depth[here] > 0)
            owners = pa.StructArray.from_arrays(
                [pa.array(x[here][mine]) for x in (b, n, size, depth)], ["a", "n", "size", "depth"])
            columns = [pa.array(user[ends[:-1]]), pa.array(chunk[ends[:-1]]), pa.ListArray.from_arrays(
                pa.array(np.searchsorted(mine, ends - ends[0]).astype(np.int32)), owners)]
            for name, x in (("b", b), ("n", n), ("size", size)):
                kind = np.dtype(types[name])
                columns.append(pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
                    None, pa.py_buffer(((ends - ends[0]) * kind.itemsize).astype(np.int32)),
                    pa.py_buffer(np.ascontiguousarray(x[here].astype(kind)))]))
            yield pa.RecordBatch.from_arrays(columns, ["user_id", "chunk", "owns", "bs", "ns", "sizes"])

    return pack


_OWN = "struct<a:long,n:long,size:long,depth:long>"
_LISTS = f"user_id long, chunk int, owns array<{_OWN}>, bs binary, ns binary, sizes binary"


def _packed(owned: DataFrame, types: dict[str, str], cell_items: int) -> tuple[DataFrame, DataFrame | None]:
    """Every user's products as one list, written; users with too many have several, and their owners apart.

    ``owned`` is a written table, ``depth`` null where a product has no list of its own. The lists of a wide
    user have a ``chunk`` from 0 on; their owners are ``user_id, chunk, own``, once for each list that they meet.
    """
    wide = cut_lineage(owned.groupBy("user_id").agg(F.count("*").alias("items")).where(F.col("items") > cell_items)
                       .select("user_id", F.ceil(F.col("items") / cell_items).cast("int").alias("chunks")))
    many = not wide.isEmpty()
    item = [F.col("product_id").alias("b"), "n", "size"]
    narrow = owned.join(wide, "user_id", "left_anti") if many else owned
    rows = narrow.select("user_id", F.lit(-1).alias("chunk"), *item, F.coalesce("depth", F.lit(0)).alias("depth"))
    rest = None
    if many:
        of_wide = cut_lineage(owned.join(wide, "user_id"))
        chunk = F.pmod(F.xxhash64("product_id", F.lit("chunk")), F.col("chunks")).cast("int")
        rows = rows.unionByName(of_wide.select("user_id", chunk.alias("chunk"), *item, F.lit(0).cast("long").alias("depth")))
        own = F.struct(F.col("product_id").alias("a"), "n", "size", "depth")
        rest = of_wide.where(F.col("depth").isNotNull()).select(
            "user_id", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), own.alias("own"))
    tasks = max(pair_tasks(owned), math.ceil(owned.count() / CELL_PAIRS))
    lists = cut_lineage(rows.repartition(tasks, "user_id", "chunk").mapInArrow(_packer(types), _LISTS))
    return lists, rest


def _owner_rounds(rows: DataFrame, depths: DataFrame | int, wanted: Callable[[DataFrame, Callable], DataFrame],
                  cell_items: int = CELL_ITEMS, best: bool = False, least: float = 0.0) -> DataFrame:
    """What ``wanted`` makes of the co-rating counts of ordered pairs ``a, b`` where ``a`` has a list, written.

    The counts are ``a, cell, b, co, depth, size_a, size_b``, all of an owner's in one table; ``wanted`` gets them
    and a function that tells a product's owners of the round.

    The lists' owners are those of ``depths`` or, with one depth for all, all products. A user's products
    are shuffled as lists of bytes, once per owner among them, and become pairs only where these are counted. A
    product's pairs are cut into cells by how many its users will form. With ``best``, a cell gives its
    first ``depth`` pairs only, with their ``rank`` in the cell; pairs less similar than ``least`` are left out.

    Owners come in rounds, as many as keep the pairs of one within ``ROUND_PAIRS`` per row, and what
    is wanted of a round is written before the next, so the pairs of all are never on disk together.
    """
    rated = rows.where(F.col("user_id").isNotNull())
    owned = cut_lineage(
        (rated.withColumn("depth", F.lit(depths)) if isinstance(depths, int)
         else rated.join(depths, "product_id", "left")).withColumn("depth", F.col("depth").cast("long")))
    types = _types(rows)
    lists, rest = _packed(owned, types, cell_items)
    discard(owned)
    degree = F.length("bs") / np.dtype(types["b"]).itemsize
    formed = lists.select(degree.cast("long").alias("degree"), F.explode("owns").alias("own")).select("own.a", "degree")
    if rest is not None:
        rest = cut_lineage(rest)
        parts_of_wide = lists.where("chunk >= 0")
        formed = formed.unionByName(rest.join(parts_of_wide.select(
            "user_id", "chunk", degree.cast("long").alias("degree")), ["user_id", "chunk"]).select("own.a", "degree"))
    formed = cut_lineage(formed.groupBy("a").agg(F.sum("degree").alias("formed")))
    total, entries = formed.agg(F.sum("formed")).first()[0] or 0, rows.count()
    hot = cut_lineage(formed.where(F.col("formed") > CELL_PAIRS).select(
        "a", F.ceil(F.col("formed") / CELL_PAIRS).cast("int").alias("parts")))
    no_hot = hot.isEmpty()
    rounds = max(1, math.ceil(total / max(LEAST_ROUND, ROUND_PAIRS * entries)))
    groups = max(pair_tasks(rows), math.ceil(total / rounds / CELL_PAIRS))
    columns = ("a", "cell", "n", "size", "depth", "bs", "ns", "sizes")

    def part(k: int) -> DataFrame:
        def mine(product: Column) -> Column:
            return F.pmod(F.xxhash64(product, F.lit("round")), F.lit(rounds)) == k

        of_list = ("bs", "ns", "sizes")
        met = lists.select(*of_list, F.explode(F.filter("owns", lambda x: mine(x["a"]))).alias("own"))
        if rest is not None:
            keys = ["user_id", "chunk"]
            met = met.unionByName(rest.where(mine(F.col("own.a"))).repartition(groups, *keys).join(
                parts_of_wide.select(*keys, *of_list).repartition(groups, *keys), keys).select(*of_list, "own"))
        met = met.select("own.a", F.lit(0).alias("cell"), "own.n", "own.size", "own.depth", *of_list)
        if not no_hot:
            # One product in so many pairs at most: few. A product with several cells sends each its share of the list.
            met = met.join(F.broadcast(hot), "a", "left")
            met = met.where("parts is null").select(*columns).unionByName(
                met.where("parts is not null").select(*columns, "parts").mapInArrow(
                    _shares(types), "a long, cell int, n long, size long, depth long, bs binary, ns binary, sizes binary"))
        out = "a long, cell int, b long, co long, depth long, size_a long, size_b long"
        return wanted(met.repartition(groups, "a", "cell").mapInArrow(
            _cell_counts(types, best, least), f"{out}, rank int" if best else out), mine)

    written = [cut_lineage(part(k)) for k in range(rounds)]
    for table in (lists, rest):
        if table is not None:
            discard(table)
    made = reduce(DataFrame.unionByName, written)
    if not best or no_hot:
        return made
    several = made.join(F.broadcast(hot), "a", "left_semi").drop("rank")
    return made.join(F.broadcast(hot), "a", "left_anti").unionByName(_ranked_to_depth(several).select(made.columns))


def _shares(types: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts every list into the shares of its owner's ``parts`` cells, by product."""
    def cut(row: dict) -> Iterator[dict]:
        parts = row.pop("parts")
        found = [np.frombuffer(row[f"{c}s"], types[c]) for c in ("b", "n", "size")]
        # Neighbouring numbers are spread; the same product has the same cell in every list.
        spread = found[0].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        cell = (spread >> np.uint64(32)) % np.uint64(parts)
        order = np.argsort(cell, kind="stable")
        cells, begins = np.unique(cell[order], return_index=True)
        for c, i, j in zip(cells, begins, np.append(begins, len(cell))[1:], strict=True):
            yield row | {"cell": int(c)} | {f"{name}s": x[order[i:j]].tobytes()
                                            for name, x in zip(("b", "n", "size"), found, strict=True)}

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([field for field in batch.schema if field.name != "parts"])
            for first in range(0, batch.num_rows, 256):
                rows = [made for row in batch.slice(first, 256).to_pylist() for made in cut(row)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return share


def _cell_counts(types: dict[str, str], best: bool, least: float
                 ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts the pairs of the owners ``a, cell`` of a partition with their users' lists."""
    # The functions stand by themselves, so workers need no copy of this package.
    def values(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
        """All lists of a column end to end, and where each ends."""
        kind, found, ends, done = np.dtype(types[name]), [], [], 0
        for chunk in table.column(f"{name}s").chunks:
            at = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            found.append(np.frombuffer(chunk.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind))
            ends.append((at[1:].astype(np.int64) - at[0]) // kind.itemsize + done)
            done += len(found[-1])
        return np.concatenate(found), np.concatenate(ends)

    def summed(owner: np.ndarray, b: np.ndarray, size: np.ndarray, co: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One row per owner and ``b``, in that order, with the sum of ``co``."""
        low = int(b.min())
        width, sizes, most = int(b.max()) - low + 1, int(size.max()).bit_length(), int(co.max()).bit_length()
        if int(size.min()) >= 0 and int(co.min()) >= 0 and ((int(owner.max()) + 1) * width) << (sizes + most) < 1 << 62:
            # All as one number, which is sorted fastest.
            row = np.sort((((owner * width + (b - low)) << sizes | size) << most) | co)
            pair = row >> most
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            co, pair = np.add.reduceat(row & ((1 << most) - 1), first), pair[first]
            owner, b = np.divmod(pair >> sizes, width)
            return owner, b + low, pair & ((1 << sizes) - 1), co
        order = np.lexsort((b, owner))
        owner, b, size, co = (x[order] for x in (owner, b, size, co))
        first = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(b) != 0)))
        return owner[first], b[first], size[first], np.add.reduceat(co, first)

    def first_places(owner: np.ndarray, strength: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of each owner that are its strongest, in order and with their ranks; equal ones by place."""
        begins = np.flatnonzero(np.append(True, np.diff(owner) != 0))
        ends = np.append(begins[1:], len(owner))
        kept = np.ones(len(owner), bool)
        for i in np.flatnonzero(ends - begins > 2 * depth[begins]):
            mine, k = strength[begins[i]:ends[i]], depth[begins[i]]
            kept[begins[i]:ends[i]] = mine >= np.partition(mine, len(mine) - k)[len(mine) - k]
        at = np.flatnonzero(kept)
        at = at[np.lexsort((-strength[at], owner[at]))]  # stable
        begins = np.flatnonzero(np.append(True, np.diff(owner[at]) != 0))
        place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at)))) + 1
        inside = place <= depth[at]
        return at[inside], place[inside]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        # Owners are pairs of product and cell: the cells of a product share no ``b``.
        a, cell, n_a, size_a, depth = (table.column(c).to_numpy() for c in ("a", "cell", "n", "size", "depth"))
        order = np.lexsort((cell, a))
        new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(cell[order]) != 0))
        number = np.empty(len(a), np.int64)
        number[order] = np.cumsum(new) - 1
        of_owner = order[new]
        (b, ends), (n_b, _), (size_b, _) = (values(table, c) for c in ("b", "n", "size"))
        row = np.repeat(np.arange(len(a)), np.diff(np.append(0, ends)))
        other = a[row] != b
        row, b, n_b, size_b = row[other], b[other].astype(np.int64), n_b[other], size_b[other].astype(np.int64)
        if not len(b):
            return
        owner, b, size_b, co = summed(number[row], b, size_b, n_a[row] * n_b.astype(np.int64))
        if best:
            at, rank = first_places(owner, co.astype(np.float64) * co / size_b, depth[of_owner][owner])
            more = [pa.array(rank.astype(np.int32))]
        else:
            near = co > least * (1 - 1e-9) * np.sqrt(size_a[of_owner][owner].astype(np.float64) * size_b)
            at, more = np.flatnonzero(near) if least > 0 else np.arange(len(b)), []
        of = of_owner[owner[at]]
        made = pa.RecordBatch.from_arrays(
            [*(pa.array(x) for x in (a[of], cell[of], b[at], co[at], depth[of], size_a[of], size_b[at])), *more],
            ["a", "cell", "b", "co", "depth", "size_a", "size_b", *(["rank"] if best else [])])
        for first in range(0, made.num_rows, 1 << 16):
            yield made.slice(first, 1 << 16)

    return count


def _ranked_to_depth(counts: DataFrame) -> DataFrame:
    return topk_to_depth(counts, "a", "cell", _strongest(), "depth")


def _ranked_cells(counts: DataFrame, mine: Callable[[Column], Column]) -> DataFrame:
    return counts


def pair_sims(rows: DataFrame, keys: DataFrame, least: float = 0.0) -> DataFrame:
    """``product_id, rec_id, sim`` of the given pairs above ``least`` only, from ``user_items`` rows.

    ``keys`` has pairs ``product_id, rec_id``, which may repeat. The ratings of the less rated product
    of a pair are looked up under the other one, so no other pairs are formed. Where the
    users' own pairs take less work than the ratings to look up, they are formed and the keys
    picked from them; both ways give the same.
    """
    per_user = rows.groupBy("user_id").agg(F.count("*").cast("double").alias("d"))
    formed = per_user.agg(F.sum(F.col("d") * F.col("d"))).first()[0] or 0
    close = F.col("sim") > least
    pair = ["product_id", "rec_id"]
    asked_of = cut_lineage(keys.groupBy("product_id").agg(F.count("*").alias("asked")))
    # Every pair takes a lookup at least.
    if formed > LOOKUP_PAIRS * (asked_of.agg(F.sum("asked")).first()[0] or 0):
        keys = cut_lineage(keys.distinct())
        sizes = cut_lineage(rows.groupBy("product_id").agg(F.max("size").alias("size")))
        first = sizes.withColumnRenamed("size", "size_a")
        second = sizes.select(F.col("product_id").alias("rec_id"), F.col("size").alias("size_b"))
        fewer = F.col("size_a") <= F.col("size_b")
        sized = (
            keys.join(first, "product_id").join(second, "rec_id")
            .withColumns({"few": F.when(fewer, F.col("product_id")).otherwise(F.col("rec_id")),
                          "many": F.when(fewer, F.col("rec_id")).otherwise(F.col("product_id"))}))
        if formed > (sized.agg(F.sum(F.least("size_a", "size_b"))).first()[0] or 0):
            sized = cut_lineage(sized)
            few = rows.select(F.col("product_id").alias("few"), "user_id", F.col("n").alias("n_few"))
            many = rows.select(F.col("product_id").alias("many"), "user_id", F.col("n").alias("n_many"))
            return (sized.join(few, "few").join(many, ["many", "user_id"])
                    .groupBy("product_id", "rec_id", "size_a", "size_b")
                    .agg(F.sum(F.col("n_few") * F.col("n_many")).alias("co"))
                    .select("product_id", "rec_id",
                            cooccurrence_sim(F.col("co"), F.col("size_a"), F.col("size_b")).alias("sim"))
                    .where(close))
    if formed <= LEAST_ROUND:
        # Pairs and keys are dealt out alike, by the smaller and the larger product, and meet there.
        one, two = F.col("product_id"), F.col("rec_id")
        asked = keys.groupBy(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).agg(
            F.bool_or(one < two).alias("up"), F.bool_or(one > two).alias("down"))
        ways = F.array(F.when(F.col("up"), F.struct(F.col("a").alias("product_id"), F.col("b").alias("rec_id"))),
                       F.when(F.col("down"), F.struct(F.col("b").alias("product_id"), F.col("a").alias("rec_id"))))
        return (pair_counts(rows).join(asked, ["a", "b"])
                .select(F.explode(F.array_compact(ways)).alias("way"), cooccurrence_sim(
                    F.col("co"), F.col("size_a"), F.col("size_b")).alias("sim"))
                .select("way.product_id", "way.rec_id", "sim").where(close))
    owners = asked_of.select("product_id", F.lit(1).alias("depth"))

    def asked_for(counts: DataFrame, mine: Callable[[Column], Column]) -> DataFrame:
        # Few counts are close; each round meets its own keys only.
        near = counts.select(F.col("a").alias("product_id"), F.col("b").alias("rec_id"), cooccurrence_sim(
            F.col("co"), F.col("size_a"), F.col("size_b")).alias("sim")).where(close)
        return keys.where(mine(F.col("product_id"))).join(near, pair).groupBy(pair).agg(F.first("sim").alias("sim"))

    return _owner_rounds(rows, owners, asked_for, least=least)


def _with_heavy(rows: DataFrame, heavy: DataFrame, k: int | None, cell_items: int,
                depths: DataFrame | None = None) -> DataFrame:
    """Candidate pairs with exact counts that hold every product's top ``k``.

    With ``depths``, a written table ``product_id, depth``, in place of ``k``: the pairs of
    these products only, each to its own depth, dealt into cells by ``a, cell``.

    A product in the true list either shares a light user with the owner of the
    list (those pairs are all formed, and get the heavy users' share added), or
    it is among the owner's top ``k`` counting heavy users only: with no light
    share its score is its heavy score, and nobody's score is below that.
    """
    wide = cut_lineage(rows.join(heavy, "user_id", "left_semi"))

    # Products with the same multiplicities under the heavy users are alike to them: one
    # profile each, found by a fingerprint of 128 bits and named by its smallest product.
    shape = [F.bit_xor(F.xxhash64("user_id", "n", F.lit(seed))).alias(f"shape{seed}")
             for seed in (1, 2)]
    shaped = cut_lineage(wide.groupBy("product_id", "size").agg(*shape))
    profiles = cut_lineage(shaped.groupBy("shape1", "shape2")
                           .agg(F.min("product_id").alias("profile")))
    members = cut_lineage(shaped.join(profiles, ["shape1", "shape2"])
                          .select("product_id", "size", "profile"))
    shapes = cut_lineage(wide.join(profiles.select(F.col("profile").alias("product_id")),
                                   "product_id", "left_semi")
                         .select(F.col("product_id").alias("profile"), "user_id", "n"))
    dots = cut_lineage(_profile_dots(shapes, cell_items))

    # A product's list is at most as deep as its profile's, which leaves out nobody but itself.
    if depths is None:
        reach = profiles.select(F.col("profile").alias("a"), F.lit(k + 1).alias("reach"))
        deepest = k + 1
    else:
        reach = cut_lineage(members.join(depths, "product_id").groupBy(F.col("profile").alias("a"))
                            .agg((F.max("depth") + 1).alias("reach")))
        deepest = reach.agg(F.max("reach")).first()[0] or 1
    best = cut_lineage(topk_per_key(members, "profile", [F.asc("size"), F.asc("product_id")],
                                    deepest, "place"))
    first = best.where("place = 1").select(
        F.col("profile").alias("b"), F.col("size").alias("b_size"),
        F.col("product_id").alias("b_first"))
    # A member is beaten by the members before it and by the first ones of the profiles before its own.
    near = topk_per_key(dots.join(first, "b").join(reach, "a"), "a",
                        [F.desc(_strength("co", "b_size")), F.asc("b_first")],
                        None if depths is not None else deepest, "turn").where("turn <= reach")
    lists = cut_lineage(topk_per_key(
        near.select("a", "b", "co", "turn", "reach").join(best.withColumnRenamed("profile", "b"), "b")
        .where("turn + place - 1 <= reach"), "a",
        [F.desc(_strength("co", "size")), F.asc("product_id")],
        None if depths is not None else deepest).where("rank <= reach"))
    owners = members if depths is None else members.join(
        depths.select("product_id"), "product_id", "left_semi")
    heavy_only = (owners.select(F.col("profile").alias("a"), F.col("product_id").alias("owner"),
                                F.col("size").alias("size_a"))
                  .join(lists.select("a", "product_id", "co", F.col("size").alias("size_b")), "a")
                  .where("owner <> product_id")
                  .select(F.col("owner").alias("a"), F.col("product_id").alias("b"),
                          "co", "size_a", "size_b"))

    # The profile travels with the product, so the light pairs are joined once.
    light_rows = cut_lineage(
        rows.join(heavy, "user_id", "left_anti")
        .join(members.select("product_id", "profile"), "product_id", "left"))
    share = dots.select(F.col("a").alias("profile_a"), F.col("b").alias("profile_b"),
                        F.col("co").alias("extra"))

    def topped_up(light: DataFrame, *more: str) -> DataFrame:
        return light.join(share, ["profile_a", "profile_b"], "left").select(
            "a", "b", (F.col("co") + F.coalesce("extra", F.lit(0))).alias("co"), "size_a", "size_b", *more)

    # Where both know a pair, the topped-up count is the larger and the true one. A
    # topped-up pair outside its own top k is out for good, whatever the other says.
    if depths is None:
        light = pair_counts(light_rows, cell_items, ("size", "profile"))
        known = _first(mirrored(topped_up(light)), k).drop("rank")
    else:
        light = _owner_pair_counts(light_rows, depths, ("size", "profile"))
        known = _ranked_to_depth(topped_up(light, "cell", "depth")).drop("rank", "cell", "depth")
    both = (known.unionByName(heavy_only).groupBy("a", "b")
            .agg(F.max("co").alias("co"), F.max("size_a").alias("size_a"),
                 F.max("size_b").alias("size_b")))
    if depths is None:
        return both
    # Two lists of at most ``depth`` rows each: no product has more than one cell of them.
    return both.join(depths.select(F.col("product_id").alias("a"), "depth"), "a").withColumn(
        "cell", F.pmod(F.xxhash64("b"), F.ceil(F.col("depth") / CELL_PAIRS).cast("int")))


def _profile_dots(shapes: DataFrame, cell_items: int) -> DataFrame:
    """Sum of multiplicity products for all profile pairs, both ways and with itself.

    Users of different taste make many profiles. Their products are taken tile by tile where that
    ships fewer rows than the users have pairs of profiles, and user by user otherwise.
    """
    per_user = shapes.groupBy("user_id").agg(F.count("*").cast("double").alias("d"))
    users, entries, pairs = per_user.agg(F.count("*"), F.sum("d"), F.sum(F.col("d") * F.col("d") / 2)).first()
    profiles = shapes.agg(F.count_distinct("profile")).first()[0]
    tiles = tiles_for(profiles, int(entries or 0))
    if entries and entries * tiles < pairs:
        entries = shapes.select(F.col("profile").alias("item"), F.col("user_id").alias("col"), "n")
        return row_products(entries, tiles, -(-users // BLOCK_COLUMNS))
    as_items = shapes.select("user_id", F.col("profile").alias("product_id"), "n",
                             F.lit(0).cast("long").alias("size"))
    own = shapes.groupBy(F.col("profile").alias("a")).agg(
        F.sum(F.col("n") * F.col("n")).alias("co")).select("a", F.col("a").alias("b"), "co")
    return mirrored(pair_counts(as_items, cell_items)).select("a", "b", "co").unionByName(own)


def itemcf_lists(ratings: DataFrame, k: int = LIST_SIZE) -> DataFrame:
    """The stored form: one nested list per product."""
    flat = itemcf_topk(ratings, k).select(
        "product_id", "rank", F.col("rec_id"), F.col("sim").alias("score"))
    renamed = flat.select(F.col("product_id").alias("owner"), "rank",
                          F.col("rec_id").alias("product_id"), "score")
    return ranked_lists(renamed, "owner", k).withColumnRenamed("owner", "product_id")
