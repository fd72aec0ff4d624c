"""Search of names by pattern through an index of trigrams.

What a pattern must contain literally is cut into trigrams; names without all of them can't match. The
rarest few of these are looked up in posting lists that are sorted by trigram, and the pattern is
run on the names that have them. A pattern that must contain nothing of three letters is a scan.
"""

from __future__ import annotations

import re
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Posting lists that a search reads at most: the rarest ones.
LISTS = 4
GRAM = 3


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters, an empty array for shorter texts."""
    last = F.char_length(text) - GRAM
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i + 1, F.lit(GRAM)))
    return F.when(last >= 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def name_index(products: DataFrame) -> DataFrame:
    """``gram, product_id`` of all names; ``tables.write_layout`` by ``gram`` makes it one to search."""
    return products.where("name is not null").select(F.explode(trigrams(F.col("name"))).alias("gram"), "product_id")


def literals(pattern: str) -> list[str]:
    """Texts that every match of the pattern contains; none where that is not sure.

    Only syntax that means the same to the parser here and to the engine that matches counts: anything
    that it doesn't know, flags and escaped digits give none.
    """
    if re.search(r"\\[0-9QExXuUNcGRhHvVKZz]|\(\?", pattern):
        return []
    try:
        parsed = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return []
    found, run = [], []

    def end() -> None:
        if run:
            found.append("".join(run))
            run.clear()

    def walk(items: parser.SubPattern) -> None:
        for kind, value in items:
            if kind is kinds.LITERAL:
                run.append(chr(value))
                continue
            end()
            if kind is kinds.SUBPATTERN:
                walk(value[-1])
                end()
            elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0] > 0:
                walk(value[-1])
                end()

    walk(parsed)
    end()
    return found


def required_grams(pattern: str) -> list[str]:
    """The trigrams that every match of the pattern contains, in order."""
    return sorted({t[i:i + GRAM] for t in literals(pattern) for i in range(len(t) - GRAM + 1)})


def candidates(index: DataFrame, pattern: str) -> DataFrame | None:
    """``product_id`` of the names that may match by the index; None if the pattern needs a scan.

    At most as many counts as the pattern has trigrams reach the driver.
    """
    grams = required_grams(pattern)
    if not grams:
        return None
    wanted = index.where(F.col("gram").isin(grams))
    counts = {r.gram: r["count"] for r in wanted.groupBy("gram").count().collect()}
    rarest = sorted(grams, key=lambda g: (counts.get(g, 0), g))[:LISTS]
    if not counts.get(rarest[0]):
        return index.select("product_id").limit(0)
    return (index.where(F.col("gram").isin(rarest)).groupBy("product_id")
            .agg(F.count_distinct("gram").alias("grams")).where(F.col("grams") == len(rarest)).select("product_id"))


def matching(products: DataFrame, index: DataFrame, pattern: str) -> DataFrame:
    """The products whose name matches the pattern anywhere, case-sensitively."""
    some = candidates(index, pattern)
    read = products if some is None else products.join(some, "product_id", "left_semi")
    return read.where(F.regexp_like("name", F.lit(pattern)))
