"""Corpus pipeline: toxicity, near duplicates, benchmark text, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.decontaminate import drop_contaminated
from shelfcast.llm.near_dedup import drop_near_duplicates
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.secrets import redact
from shelfcast.llm.toxicity import drop_toxic
from shelfcast.session import cut_lineage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from what the labels cover."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs, width=5, percent=80, bands=36, rows=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence, size and offset."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Trained models, components and best fit are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
