"""Staging models: one row per sample and one row per forecast point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import NTZ, ntz
from ..functions.scalar import at_path, kph_to_ms, lead_hours, m_to_km, number_or_null
from ..operators.matching import enrich_city
from ..schemas import CURRENT_RESPONSE, FORECAST_RESPONSE, METRES, OPEN_END, POINT_KEYS, RAW_PATHS

META = ["status_code", "created_at", "updated_at", "valid_from_dttm", "valid_to_dttm"]


def in_force(versions: DataFrame) -> DataFrame:
    """Versions that are still valid."""
    return versions.filter(f"valid_to_dttm = {ntz(OPEN_END)}")


def successful(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("status_code") == 200)


def provider_reading(output: str, provider: str = "sample.provider", raw: str = "sample.raw") -> str:
    """One extra reading of a sample, found where its provider puts it."""
    whens = []
    for name, path in RAW_PATHS[output].items():
        value = number_or_null(at_path(raw, path))
        whens.append(f"WHEN '{name}' THEN {m_to_km(value) if (output, name) in METRES else value}")
    return f"CASE {provider} {' '.join(whens)} END"


def explode_samples(versions: DataFrame) -> DataFrame:
    """One row per element of ``response.samples``; the response is parsed once.

    The filter stands behind the outer explode, so that it cannot make Spark parse the text again.
    """
    kept = [c for c in versions.columns if c not in ("request", "response")]
    doc = versions.select(*kept, F.from_json("response", CURRENT_RESPONSE).alias("doc"))
    return doc.selectExpr(
        *kept,
        "explode_outer(doc.samples) AS sample",
        f"{number_or_null('doc.average_temperature_c')} AS avg_temperature_c",
        f"{number_or_null('doc.average_humidity')} AS avg_humidity",
    ).filter("sample IS NOT NULL")


def explode_points(versions: DataFrame) -> DataFrame:
    """One row per ``response.forecasts[].points[]``."""
    kept = [c for c in versions.columns if c not in ("request", "response")]
    doc = versions.select(*kept, F.from_json("response", FORECAST_RESPONSE).alias("doc"))
    by_provider = doc.selectExpr(*kept, "explode_outer(doc.forecasts) AS one")
    points = by_provider.selectExpr(*kept, "one.provider AS provider", "explode_outer(one.points) AS point")
    return points.filter("point IS NOT NULL")


def parse_samples(exploded: DataFrame) -> DataFrame:
    kph = number_or_null("sample.wind_speed_kph")
    return exploded.selectExpr(
        "id",
        "weather_id",
        "latitude",
        "longitude",
        "sample.provider AS provider",
        f"try_cast(sample.observation_time AS {NTZ}) AS observation_time",
        f"{number_or_null('sample.temperature_c')} AS temperature_celsius",
        f"{number_or_null('sample.humidity')} AS humidity_percent",
        f"{kph_to_ms(kph)} AS wind_speed_ms",
        f"{kph} AS wind_speed_kph",
        *[f"{provider_reading(output)} AS {output}" for output in RAW_PATHS],
        "sample.condition AS weather_condition",
        *META,
        "avg_temperature_c",
        "avg_humidity",
    )


def parse_points(exploded: DataFrame) -> DataFrame:
    kph = number_or_null("point.wind_speed_kph")
    texts = {"weather_condition"}
    return exploded.selectExpr(
        "id",
        "forecast_id",
        "latitude",
        "longitude",
        "provider",
        f"try_cast(point.time AS {NTZ}) AS forecast_timestamp",
        f"{number_or_null('point.temperature_c')} AS temperature_celsius",
        f"{number_or_null('point.humidity')} AS humidity_percent",
        f"{kph_to_ms(kph)} AS wind_speed_ms",
        f"{kph} AS wind_speed_kph",
        *[
            f"{f'point.{key}' if output in texts else number_or_null(f'point.{key}')} AS {output}"
            for output, key in POINT_KEYS.items()
        ],
        *META,
    )


def stg_current(raw: DataFrame, cities: DataFrame) -> DataFrame:
    """Samples of valid, successful documents with their city: 28 columns."""
    samples = parse_samples(explode_samples(successful(in_force(raw))))
    return enrich_city(samples, cities).selectExpr(
        "id",
        "weather_id",
        "latitude",
        "longitude",
        "city",
        "country",
        "provider",
        "observation_time",
        "temperature_celsius",
        "humidity_percent",
        "wind_speed_ms",
        "wind_speed_kph",
        "pressure_hpa",
        "precipitation_mm",
        "cloud_cover_percent",
        "visibility_km",
        "uv_index",
        "feels_like_celsius",
        "wind_direction_degrees",
        "weather_condition",
        *META,
        "avg_temperature_c",
        "avg_humidity",
        "updated_at AS source_updated_at",
    )


def stg_forecast(raw: DataFrame, cities: DataFrame) -> DataFrame:
    """Forecast points of valid, successful documents with city and lead time: 27 columns."""
    points = parse_points(explode_points(successful(in_force(raw))))
    return enrich_city(points, cities).selectExpr(
        "id",
        "forecast_id",
        "latitude",
        "longitude",
        "city",
        "country",
        "provider",
        "forecast_timestamp",
        f"{lead_hours('forecast_timestamp', 'created_at')} AS hours_ahead",
        "temperature_celsius",
        "humidity_percent",
        "wind_speed_ms",
        "wind_speed_kph",
        *POINT_KEYS,
        "status_code",
        "created_at AS forecast_created_at",
        "updated_at",
        "valid_from_dttm",
        "valid_to_dttm",
    )
