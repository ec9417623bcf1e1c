"""Nesting of normalised answers into one document per request.

A request keeps the latest answer of each provider.  That is found while rows are grouped, in the map tasks first, so whatever
a request's number of rows, what is held and sent of it is one answer per provider.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_HOURS, MAX_HOURS, MIN_HOURS, PROVIDERS

# How JSON dates are written: ISO, with microseconds.
ISO_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _latest_of_each(fields: list[str], settle: list[str]) -> str:
    """Structs of the fields of the latest answer of each known provider, in the providers' fixed order.

    ``settle`` orders the answers of one provider; the greatest counts.
    """
    struct = lambda names: f"named_struct({', '.join(f'{n!r}, {n}' for n in names)})"
    latest = [f"max_by({struct(fields)}, {struct(settle)}) FILTER (WHERE provider = '{p}')" for p in PROVIDERS]
    return f"filter(array({', '.join(latest)}), x -> x IS NOT NULL)"


def _mean(values: str) -> str:
    known = f"filter({values}, v -> v IS NOT NULL)"
    return f"aggregate({known}, 0.0D, (total, v) -> total + v) / nullif(size({known}), 0)"


def nest_current(samples: DataFrame) -> DataFrame:
    """Per request: the samples, and their mean temperature and humidity over known values."""
    fields = ["provider", "temperature_c", "wind_speed_kph", "humidity", "condition", "observation_time"]
    if "raw" in samples.columns:
        fields.append("raw")
    settle = ["fetched_at", "temperature_c", "wind_speed_kph"]
    nested = samples.groupBy("request_id", "latitude", "longitude").agg(
        F.expr(f"{_latest_of_each(fields, settle)} AS samples"),
        F.expr("max(fetched_at) AS fetched_at"),
    )
    return nested.selectExpr(
        "request_id",
        "latitude",
        "longitude",
        "samples",
        f"{_mean('samples.temperature_c')} AS average_temperature_c",
        f"{_mean('samples.humidity')} AS average_humidity",
        "fetched_at",
    )


def nest_forecast(forecasts: DataFrame) -> DataFrame:
    """Per request: the points of each provider, nested twice, without averages."""
    nested = _latest_of_each(["provider", "points"], ["fetched_at", "points"])
    return forecasts.groupBy("request_id", "latitude", "longitude", "hours").agg(
        F.expr(f"{nested} AS forecasts"),
        F.expr("max(fetched_at) AS fetched_at"),
    )


def to_documents(nested: DataFrame, kind: str) -> DataFrame:
    """Stored form of nested responses: request and response as JSON text, with both stamps."""
    hours = ["hours"] if kind == "forecast" else []
    if kind == "current":
        body = ["latitude", "longitude", "samples", "average_temperature_c", "average_humidity"]
    else:
        body = ["latitude", "longitude", "hours", "forecasts"]
    request = [F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), *[F.col(h) for h in hours]]
    return nested.select(
        F.col("request_id").cast("string").alias("_id"),
        F.lit(kind).alias("type"),
        "latitude",
        "longitude",
        *hours,
        F.to_json(F.struct(*request)).alias("request"),
        F.to_json(F.struct(*body), ISO_JSON).alias("response"),
        F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("fetched_at").alias("created_at"),
        F.col("fetched_at").alias("updated_at"),
    )


def with_default_hours(requests: DataFrame) -> DataFrame:
    return requests.withColumn("hours", F.coalesce(F.col("hours"), F.lit(DEFAULT_HOURS)))


def hours_allowed(hours: str) -> str:
    return f"({hours} BETWEEN {MIN_HOURS} AND {MAX_HOURS})"
