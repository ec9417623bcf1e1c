"""Listings and counts over stored request documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_LIMIT, MAX_LIMIT, MIN_LIMIT


def _checked(limit: int) -> int:
    if not MIN_LIMIT <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must lie between {MIN_LIMIT} and {MAX_LIMIT}")
    return limit


def most_recent(documents: DataFrame, limit: int = DEFAULT_LIMIT, time: str = "created_at", tie: str = "_id") -> DataFrame:
    """The newest documents; each task keeps only its own ``limit`` newest."""
    limit = _checked(limit)
    return documents.orderBy(F.col(time).desc_nulls_last(), F.col(tie)).limit(limit)


def most_recent_at(
    documents: DataFrame, latitude: float, longitude: float, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """The newest successful documents of exactly one position."""
    here = documents.filter(
        (F.col("latitude") == latitude) & (F.col("longitude") == longitude) & (F.col("status_code") == 200)
    )
    return most_recent(here, limit)


def count_documents(**collections: DataFrame) -> DataFrame:
    """Number of documents per collection, and in all of them."""
    counts = None
    for name, documents in collections.items():
        one = documents.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), "n")
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("n").alias("n")).select(F.lit("total").alias("collection"), "n")
    return counts.unionByName(total)


def busiest(documents: DataFrame, keys: Sequence[str], limit: int = 5) -> DataFrame:
    """The groups with the most documents."""
    counts = documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(limit)


def summarize_current(documents: DataFrame, limit: int = 3) -> DataFrame:
    """Newest documents with their mean temperature and number of samples."""
    body = F.from_json("response", "average_temperature_c double, samples array<struct<provider string>>")
    return most_recent(documents, limit).select("*", body.alias("b")).select(
        "_id",
        "latitude",
        "longitude",
        "created_at",
        F.col("b.average_temperature_c").alias("average_temperature_c"),
        F.coalesce(F.size("b.samples"), F.lit(0)).alias("samples_count"),
    )


def summarize_forecast(documents: DataFrame, limit: int = 3) -> DataFrame:
    """Newest forecast documents with their horizon and number of providers."""
    body = F.from_json("response", "forecasts array<struct<provider string>>")
    return most_recent(documents, limit).select(
        "_id",
        "latitude",
        "longitude",
        "hours",
        "created_at",
        F.coalesce(F.size(body["forecasts"]), F.lit(0)).alias("providers_count"),
    )
