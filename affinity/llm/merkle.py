"""A Merkle manifest of documents: digests of sources and of all, with a proof for every row.

A leaf is the digest of a document's fields. The leaves of a source, in order of their ids, and the
subroots of the sources, in order of the sources, are each hashed in runs of ``FAN`` until one
digest is left.

* **Places.** Rows are dealt out by range and numbered within their partitions; the sizes of the
  partitions make these numbers places in the whole. No source is brought into one task.
* **Records.** Each run of a level is one record, from the run's digest to its children's digests.
  Records are found by their digest alone, and equal runs are stored once.
* **Descent.** A place is a number of as many hexadecimal digits as its tree has levels. Requests
  start at the root and follow the record of the node that they are at: the next digit selects a
  child, the others become a segment of the path. Requests that have the same digits so far are one
  row, so a step makes a row per node on the way to a request, and the requests themselves are
  met at the last digit only. Read backwards, the segments are the proof, from leaf to root.

Defined cases: a null field is ``-`` in a leaf, and null differs from empty. Rows without an id come
first in their source, and rows of one id, repeated rows included, follow in order of their leaves.
A null source comes first, and is another than the empty one. Rows without an id are not tampered
with. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinity.llm.stage import written

#: Children of a node, and the bits of a place that select one.
FAN, BITS = 16, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


@dataclass
class Manifest:
    """Tables of a manifest; all are written, so that proofs can be asked for at any time.

    ``leaves``: the given columns and ``tree, place, leaf``. ``records``: ``digest, children``.
    ``trees``: ``tree, source, size, subroot``. ``root``: one row ``root``, none for no documents.
    """

    leaves: DataFrame
    records: DataFrame
    trees: DataFrame
    root: DataFrame


def leaf_digest(*fields: Column) -> Column:
    """The digest of fields in order, each with its length in bytes."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def ranked(table: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``table`` with the place of each row in the order, from 0. The result is to be written once.

    The table is read more than once, so it should be a written one. The sizes are one row per
    partition, which is what bounds the window over them and their broadcast.
    """
    number = f"{name}_in_part"
    numbered = written(table.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn(number, F.monotonically_increasing_id()))
    part = F.shiftright(number, 33)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return (numbered.join(F.broadcast(before), part == F.col("part"))
            .withColumn(name, F.col("before") + F.col(number).bitwiseAND((1 << 33) - 1))
            .drop(number, "part", "before"))


def _levels(size: Column) -> Column:
    """Levels above the leaves of a tree with ``size`` leaves: the digits of its last place."""
    return F.when(size > 1, F.length(F.hex(size - 1))).otherwise(0)


def _grow(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records ``digest, children`` and tops ``tree, digest`` of trees of ``tree, place, size, digest``."""
    levels = nodes.agg(F.max(_levels(F.col("size")))).first()[0] or 0
    tops = nodes.where("size = 1").select("tree", "digest")
    records = nodes.select("digest", F.array("digest").alias("children")).limit(0)
    for _ in range(levels):
        run = F.shiftright("place", BITS).alias("place")
        nodes = written(nodes.where("size > 1").groupBy("tree", run, "size")
                        .agg(F.array_sort(F.collect_list(F.struct("place", "digest")))["digest"].alias("children"))
                        .select("tree", "place", F.shiftright(F.col("size") + (FAN - 1), BITS).alias("size"),
                                F.sha2(F.array_join("children", ""), 256).alias("digest"), "children"))
        records = records.union(nodes.select("digest", "children"))
        tops = tops.union(nodes.where("size = 1").select("tree", "digest"))
    return records, tops


def build(leaves: DataFrame) -> Manifest:
    """The manifest of ``doc_id, source, leaf`` and any other columns, which ``leaves`` keeps."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    placed = written(ranked(leaves, order, "place"))
    sources = written(placed.groupBy("source").agg(F.min("place").alias("start"), F.count("*").alias("size")))
    trees = written(ranked(sources, [F.col("source").asc_nulls_first()], "tree")
                    .withColumnRenamed("source", "name"))
    placed = written(placed.join(trees, placed["source"].eqNullSafe(trees["name"]))
                     .withColumn("place", F.col("place") - F.col("start")).drop("name", "start"))
    low, subroots = _grow(placed.select("tree", "place", "size", F.col("leaf").alias("digest")))
    subroots = written(subroots.withColumnRenamed("digest", "subroot"))
    count = trees.count()
    high, root = _grow(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"),
                                       F.lit(count).cast("long").alias("size"), F.col("subroot").alias("digest")))
    records = low.union(high).groupBy("digest").agg(F.first("children").alias("children"))
    trees = trees.join(subroots, "tree").select("tree", F.col("name").alias("source"), "size", "subroot")
    return Manifest(placed, written(records), written(trees), written(root.select(F.col("digest").alias("root"))))


def _segment(children: Column, at: Column) -> Column:
    """The children before and after the one at ``at``, each joined to one text."""
    def joined(first: Column, n: Column) -> Column:
        return F.array_join(F.slice(children, first, n), "")

    return F.struct(joined(F.lit(1), at).alias("before"), joined(at + 2, F.lit(FAN)).alias("after"))


def _descend(start: DataFrame, records: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of ``tree, place, left, digest, path`` from the nodes of ``start`` to the ``targets``.

    ``targets`` are ``tree, place, levels``, ``left`` is the number of digits yet to follow.
    """
    steps = targets.agg(F.max("levels")).first()[0] or 0
    here = start
    for step in range(steps):
        on = here.where("left > 0").join(records, "digest").select(
            "tree", "place", "left", "path", "children", F.posexplode("children").alias("digit", "digest"))
        on = on.select("tree", (F.col("place") * FAN + F.col("digit")).alias("place"),
                       (F.col("left") - 1).alias("left"), "digest",
                       F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"))
        wanted = (targets.where(F.col("levels") > step)
                  .selectExpr("tree", f"shiftright(place, {BITS} * (levels - {step + 1})) as place").distinct())
        here = written(on.join(wanted, ["tree", "place"], "left_semi").union(here.where("left = 0")))
    return here


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` with ``root, subroot, path`` of each: the path has its segments from leaf to root.

    ``requests`` has ``tree, place`` of the leaves asked for, and any other columns.
    """
    count = manifest.trees.count()
    top = len(f"{count - 1:x}") if count > 1 else 0
    empty = F.array().cast(_PATH).alias("path")
    root = manifest.root.select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("place"),
                                F.lit(top).alias("left"), F.col("root").alias("digest"), empty)
    asked = requests.select("tree").distinct().select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(top).alias("levels"))
    found = _descend(root, manifest.records, written(asked)).select(F.col("place").alias("tree"), "digest", "path")
    start = found.join(manifest.trees.select("tree", "size"), "tree").select(
        "tree", F.lit(0).cast("long").alias("place"), F.greatest(_levels(F.col("size")) - 1, F.lit(0)).alias("left"),
        "digest", "path")
    runs = written(requests.withColumn("run", F.shiftright("place", BITS)).groupBy("tree", "run").agg(
        F.collect_list(F.struct(*[F.col(f"`{c}`") for c in requests.columns])).alias("requests")))
    targets = runs.select("tree", F.col("run").alias("place")).join(
        manifest.trees.select("tree", F.greatest(_levels(F.col("size")) - 1, F.lit(0)).alias("levels")), "tree")
    met = _descend(written(start), manifest.records, written(targets)).select(
        "tree", F.col("place").alias("run"), "digest", "path")
    parts = (runs.join(met, ["tree", "run"]).join(manifest.trees.select("tree", "size", "subroot"), "tree")
             .join(manifest.records, "digest", "left").join(F.broadcast(manifest.root))
             .select("root", "subroot", "path", "children", "size", F.explode("requests").alias("request")))
    at = F.col("request.place").bitwiseAND(FAN - 1).cast("int")
    whole = F.when(F.col("size") > 1, F.concat("path", F.array(_segment(F.col("children"), at)))).otherwise(F.col("path"))
    return parts.select("request.*", "root", "subroot", F.reverse(whole).alias("path"))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def audit(documents: DataFrame) -> DataFrame:
    """One row per document: its digests, its proof's digest, and the root that a tampered copy gives.

    The text of every document whose id's crc32 is divisible by 5 is lower-cased (A-Z) for the copy.
    """
    *fields, text = (F.col(c) for c in FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = leaf_digest(*fields, F.translate(text, UPPER, LOWER))
    leaves = written(documents.select("doc_id", "source", leaf_digest(*fields, text).alias("leaf"),
                                      F.when(tampered, lower).alias("tampered")))
    manifest = build(leaves)
    return (proofs(manifest, manifest.leaves.select("tree", "place", "doc_id", "leaf", "tampered"))
            .withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def oracle_sql(levels: int = 5, high: int = 2) -> str:
    """DuckDB SQL for sources of at most ``16^levels`` documents and at most ``16^high`` sources."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in FIELDS[:-1])} || {field(text)})"

    bits = "list_reduce(list_prepend(xor(a, b), range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    crc = f"""xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''),
        lambda s: unicode(s)::bigint)), lambda a, b: {bits}), 4294967295)"""
    ctes = [f"""leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0
        THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents)""",
            """a0 AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER
        (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS size,
        leaf AS digest FROM leaves)"""]
    ctes += _sql_levels("a", levels)
    tops = " UNION ALL ".join(f"SELECT tree, digest FROM a{k} WHERE size = 1" for k in range(levels + 1))
    ctes += [f"subroots AS ({tops})", "b0 AS (SELECT 0 AS tree, tree AS place, count(*) OVER () AS size, digest FROM subroots)"]
    ctes += _sql_levels("b", high)
    roots = " UNION ALL ".join(f"SELECT digest AS root FROM b{k} WHERE size = 1" for k in range(high + 1))
    joins, parts, fold = [], [], "coalesce(tampered, leaf)"
    for name, tree, place, n in (("a", "l.tree", "l.place", levels), ("b", "0", "l.tree", high)):
        for k in range(n):
            run = f"{name}r{k}"
            at = f"(({place} >> {BITS * k}) & 15)"
            joins.append(f"LEFT JOIN {run} ON {run}.tree = {tree} AND {run}.place = ({place} >> {BITS * (k + 1)})")
            before, after = f"array_to_string({run}.kids[1:{at}], '')", f"array_to_string({run}.kids[{at} + 2:16], '')"
            parts.append(f"coalesce({before} || {after}, '')")
            fold = f"(CASE WHEN {run}.kids IS NULL THEN {fold} ELSE sha256({before} || {fold} || {after}) END)"
    return f"""WITH {', '.join(ctes)}, root AS ({roots}), folds AS (SELECT doc_id, leaf, s.digest AS subroot, root.root,
        sha256({' || '.join(parts)}) AS proof_sha256, {fold} AS folded_root FROM a0 l JOIN subroots s ON s.tree = l.tree
        CROSS JOIN root {' '.join(joins)})
        SELECT *, folded_root = root AS verified FROM folds"""


def _sql_levels(name: str, levels: int) -> list[str]:
    out = []
    for k in range(levels):
        out += [f"""{name}r{k} AS (SELECT tree, place // 16 AS place, any_value((size + 15) // 16) AS size,
            list(digest ORDER BY place) AS kids FROM {name}{k} WHERE size > 1 GROUP BY 1, 2)""",
                f"{name}{k + 1} AS (SELECT tree, place, size, sha256(array_to_string(kids, '')) AS digest FROM {name}r{k})"]
    return out
