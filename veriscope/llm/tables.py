"""Input tables, and small column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Only A-Z in lower case; NULL stays NULL.

    ``lower`` does the same, and much faster, for a text of ASCII characters alone.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside another lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)
