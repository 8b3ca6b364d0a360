"""The training-data pipeline: classify, clean, deduplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terragrid.llm.common import table, written
from terragrid.llm.decontamination import clean_documents
from terragrid.llm.gbt_quality import good_documents
from terragrid.llm.packing import pack_documents
from terragrid.llm.quality_rules import kept_documents
from terragrid.llm.simhash import one_of_each
from terragrid.shipping import ensure_shipped


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that fail."""
    ensure_shipped(spark)
    return kept_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ensure_shipped(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage by the contamination rule."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    ensure_shipped(spark)
    return pack_documents(docs)


STAGES = [("quality classifier", classify), ("quality rules", clean), ("simhash near-dedup", deduplicate), ("benchmark decontamination", decontaminate), ("packing", pack)]

#: Trained trees, hashes and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
