"""A corpus from raw documents to packed sequences, as stages that each write Parquet for the next one.

Language ID rejects documents without a language; exact and near duplicates leave one document of each group; the mix
brings sources to their target weights, repeating small ones; packing cuts and packs what is left into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import exact, langid, mixing, packing, simhash
from stratum.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a network fitted on the labelled ones among them can tell."""
    return langid.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact.latest_rows(docs, exact.half())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 3-word shingles within 2 bits, that with the smallest doc_id."""
    return simhash.first_rows(docs, words=3, radius=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a document that it takes a part of is taken whole."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack_documents(docs, packing.vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

# SQL cannot express a trained network; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"corpus-{name.replace('_', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
