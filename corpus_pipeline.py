"""From documents to packed training sequences: quality, near duplicates, benchmark leaks, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from washline.llm import decontamination, packing, quality, simhash
from washline.llm.common import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject.

    A null text is judged as an empty one; equal rows stay or go together; columns of any name stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # The score's columns take no name from a document's.
    plain = docs.toDF(*(c if c == "text" else f"column{i}" for i, c in enumerate(docs.columns)))
    scored = quality.score(plain, quality.fit(docs, labels))
    return scored.where("predicted = 1").select(plain.columns).toDF(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the least doc_id; rows that share this id, and rows without an id, stay.

    A null text counts as empty, and empty texts are near duplicates of each other.
    """
    return simhash.one_of_each(docs, shingle=3, distance=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; null and empty texts hold none, equal rows stay or go together."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of 2048 tokens; a null text is the end token alone, equal rows are packed each."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: Neither compression, 64-bit hashing of shingles nor tokenization can be stated in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
