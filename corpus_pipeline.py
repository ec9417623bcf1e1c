"""The corpus pipeline: stages from raw documents to packed sequences, each one an operator of ``veriscope.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriscope.llm import fertility, near_dup, packing, secrets, winnowing
from veriscope.llm.tables import DOCUMENTS, table
from veriscope.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands keep."""
    return fertility.fertility(docs, carry=DOCUMENTS).filter("kept").select(*DOCUMENTS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dup.deduplicated(docs.select(*DOCUMENTS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than a twentieth of their words from the benchmark."""
    return winnowing.clean(docs.select(*DOCUMENTS), table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of every secret; ``n_chars`` counts the new text."""
    found = secrets.find(docs, carry=DOCUMENTS)
    text = F.when(F.col("text").isNotNull(), secrets.masked(F.col("text"), F.col("spans")))
    changed = found.withColumn("text", text)
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", n_chars).select(*DOCUMENTS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their token ids and their places in the sequences.

    The ids are what the other stages' work comes to: the texts made by those stages go with the application.
    """
    return packing.packed(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None  # tokenizers and fitted cutoffs are beyond SQL; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
