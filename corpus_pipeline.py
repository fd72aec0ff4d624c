"""A training corpus from raw documents: filter, deduplicate, decontaminate, mask, tokenise."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinity.llm import pieces
from affinity.llm.bagminhash import keep_one
from affinity.llm.containment import drop_contaminated
from affinity.llm.pseudonyms import pseudonymise
from affinity.llm.queries import read
from affinity.llm.stage import written
from affinity.llm.toxicity import drop_toxic

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go; it learns from the labels of ``docs``."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms; ``n_chars`` follows the new texts."""
    return pseudonymise(docs, chars="n_chars").select(*[f"`{c}`" for c in docs.columns])


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces and the text that these decode to."""
    return pieces.with_ids(docs, pieces.load(MODEL))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pseudonyms", pseudonym_stage),
    ("pieces", piece_stage),
]

#: The learnt score of the first stage and the hashed permutations of the fourth have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
