"""The corpus pipeline: quality, exact dedup, SimHash near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
all that the stage before it kept, and its output is written as Parquet in the
cluster's shared folder and read again as the next stage's documents.  All
stages but the last return the columns of ``documents``; the last returns the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelkit.llm.common import documents, table, written
from labelkit.llm.exact_dedup import deduplicate
from labelkit.llm.mixing import mixed_documents
from labelkit.llm.packing import pack
from labelkit.llm.quality import keep_good
from labelkit.llm.queries import tokenizer_path
from labelkit.llm.simhash import drop_near_duplicates


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text stays, the one with the largest id."""
    return deduplicate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id."""
    return drop_near_duplicates(docs)


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their mixed weights, within a budget of as many tokens as came in; a document
    comes once for each epoch that takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("temperature mixing", temperature_mixing),
    ("packing", packing),
]

#: SimHash components, trained trees and tokenizer ids have no SQL form; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
