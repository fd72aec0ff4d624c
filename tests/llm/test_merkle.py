"""The manifest against a plain tree of lists, and proofs of single leaves."""

import random
import zlib
from hashlib import sha256
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from affinity.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root and, per node, the siblings before and after on each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            first = place // 16 * 16
            paths[i].append(("".join(nodes[first:place]), "".join(nodes[place + 1:first + 16])))
            at[i] = place // 16
        nodes = [h("".join(nodes[k:k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], leaf_of(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for name in names:
        leaves = sorted(by_source[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        found[name] = leaves, tree([x[1] for x in leaves])
    root, above = tree([found[name][1][0] for name in names])
    out = []
    for name, high in zip(names, above, strict=True):
        leaves, (subroot, paths) = found[name]
        for (doc_id, leaf, row), path in zip(leaves, paths, strict=True):
            path = path + high
            folded = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf_of((*row[:4], row[4].encode().translate(
                    bytes.maketrans(merkle.UPPER.encode(), merkle.LOWER.encode())).decode()))
            for before, after in path:
                folded = h(before + folded + after)
            proof = h("".join(b + a for b, a in path))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def corpus(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((rng.randrange(10 ** rng.randint(1, 9)), source, rng.choice(["en", "de", None, ""]),
                         rng.choice([None, 5]), rng.choice([None, "", "a Text", "É Ünï 鼠 Z", "x" * rng.randrange(3000)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"hot": 700, "b": 17, "one": 1, None: 16, "": 2, "é": 33}, {"a": 1}, {"a": 16}, {"a": 257},
    {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_against_plain_trees(spark, sizes):
    rows = corpus(len(sizes), sizes)
    got = merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_repeated_rows_nulls_and_other_columns(spark):
    rows = [(7, "a", "en", 1, "Same")] * 40 + [(7, "a", "en", 1, "Other")] * 2 + [(None, "a", None, None, None)] * 20
    rows += [(None, None, None, None, None), (0, "", "", 0, "")]
    docs = (spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(3))
            .withColumn("place", F.lit("p")).withColumn("a.b", F.lit(1)))
    out = merkle.audit(docs)
    assert tuple(out.columns) == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows)
    assert merkle.audit(docs.limit(0)).count() == 0


def test_a_few_requests_descend_alone(spark):
    """Paths of single leaves, from the written tables of a manifest."""
    rows = corpus(3, {"a": 300, "b": 20, "c": 1})
    docs = spark.createDataFrame(rows, SCHEMA)
    manifest = merkle.build(docs.select("doc_id", "source", merkle.leaf_digest(*map(F.col, merkle.FIELDS)).alias("leaf")))
    assert manifest.records.count() == manifest.records.select("digest").distinct().count()
    asked = manifest.leaves.where("(source = 'a' and place in (0, 77, 299)) or source = 'c'")
    got = merkle.proofs(manifest, asked.select("tree", "place", "leaf")).withColumn(
        "again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == 4 and all(r.again == r.root for r in got)
    assert sorted(len(r.path) for r in got) == [1, 4, 4, 4]


def test_sql_gives_the_same(spark, tmp_path):
    rows = corpus(4, {"hot": 300, None: 3, "x": 18, "y": 1})
    docs = spark.createDataFrame(rows, SCHEMA)
    path = Path(tmp_path) / "documents"
    docs.write.parquet(str(path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        cur = db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.oracle_sql()})")
        assert sorted(cur.fetchall(), key=str) == plain(rows)
