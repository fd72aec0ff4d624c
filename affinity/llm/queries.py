"""One query per operator, over whole tables, with production parameters; and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinity.llm import (bagminhash, containment, golay, merkle, outliers, pieces, pseudonyms, reputation,
                          suffix_dedup, templates, whitening)
from affinity.llm.quality import quality
from affinity.llm.toxicity import toxicity


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(read(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(read(spark, sf_dir, "pages"))


def op5_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    proto = pieces.load(model or public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trip(read(spark, sf_dir, "documents"), proto)


def op6_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return reputation.judge(pages, reputation.page_outcomes(pages, read(spark, sf_dir, "labels")))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(documents)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read(spark, sf_dir, "documents"))


def op12_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay.near_duplicates(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_outliers": op1_outliers,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_templates": op4_templates,
    "op5_pieces": op5_pieces,
    "op6_containment": op6_containment,
    "op7_bagminhash": op7_bagminhash,
    "op8_quality": op8_quality,
    "op9_reputation": op9_reputation,
    "op10_pseudonyms": op10_pseudonyms,
    "op11_merkle": op11_merkle,
    "op12_golay_simhash": op12_golay_simhash,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_outliers": outliers.oracle_sql(),
    "op6_containment": containment.oracle_sql(),
    "op9_reputation": reputation.oracle_sql(),
    "op11_merkle": merkle.oracle_sql(),
}
