"""Operational models: the latest observation and forecast per key, enriched."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scalar import bucket_horizon, c_to_f, surrogate_key, wind_cardinal
from ..operators.dedup import latest_per_key
from ..schemas import MAX_LEAD_HOURS

OBSERVATION_KEY = ["city", "provider", "observation_time"]
FORECAST_KEY = ["city", "provider", "forecast_timestamp", "hours_ahead_interval"]
PLACE = ["city", "country", "latitude", "longitude", "provider"]
WEATHER = [
    "humidity_percent",
    "wind_speed_ms",
    "wind_speed_kph",
    "pressure_hpa",
    "precipitation_mm",
    "cloud_cover_percent",
    "visibility_km",
    "uv_index",
    "wind_direction_degrees",
]


PROCESSED_NOW = "localtimestamp() AS processed_dttm"
OBSERVATION_CHANGED_AT = "coalesce(updated_at, created_at, observation_time)"
FORECAST_CHANGED_AT = "coalesce(forecast_created_at, forecast_timestamp)"


def _settled_by(rows: DataFrame) -> list[str]:
    """What decides between rows with equal stamps: the source row's id, then the warmer value."""
    return [f"{c} DESC NULLS LAST" for c in ("id", "temperature_celsius") if c in rows.columns]


def latest_observations(changed: DataFrame) -> DataFrame:
    """The last change per city, provider and time."""
    order = ["source_changed_at DESC NULLS FIRST", "updated_at DESC NULLS LAST", "created_at DESC NULLS LAST"]
    return latest_per_key(changed, OBSERVATION_KEY, [*order, *_settled_by(changed)])


def latest_forecasts(bucketed: DataFrame) -> DataFrame:
    """The last forecast per city, provider, time and lead time."""
    order = ["source_changed_at DESC NULLS FIRST", "forecast_created_at DESC NULLS LAST"]
    return latest_per_key(bucketed, FORECAST_KEY, [*order, *_settled_by(bucketed)])


def with_lead_time(forecasts: DataFrame) -> DataFrame:
    """Forecasts up to 48 hours ahead that lie at one of the lead times."""
    near = forecasts.filter(f"hours_ahead >= 0 AND hours_ahead <= {MAX_LEAD_HOURS}")
    return near.selectExpr("*", f"{bucket_horizon('hours_ahead')} AS hours_ahead_interval").filter(
        "hours_ahead_interval IS NOT NULL"
    )


TEMPERATURES = [
    "temperature_celsius",
    "feels_like_celsius",
    f"{c_to_f('temperature_celsius')} AS temperature_fahrenheit",
]
DIRECTION = f"{wind_cardinal('wind_direction_degrees')} AS wind_direction_cardinal"


def ods_observations(stg: DataFrame) -> DataFrame:
    """Deduplicated, enriched observations: 25 columns."""
    changed = stg.selectExpr("*", f"{OBSERVATION_CHANGED_AT} AS source_changed_at")
    return latest_observations(changed).selectExpr(
        f"{surrogate_key(*OBSERVATION_KEY)} AS observation_id",
        *PLACE,
        "observation_time",
        *TEMPERATURES,
        *WEATHER,
        DIRECTION,
        "weather_condition",
        "created_at AS source_created_at",
        "updated_at AS source_updated_at",
        "source_changed_at",
        PROCESSED_NOW,
    )


def ods_forecasts(stg: DataFrame) -> DataFrame:
    """Deduplicated, enriched forecasts at the lead times: 27 columns."""
    changed = stg.selectExpr("*", f"{FORECAST_CHANGED_AT} AS source_changed_at")
    return latest_forecasts(with_lead_time(changed)).selectExpr(
        f"{surrogate_key(*FORECAST_KEY)} AS forecast_id",
        *PLACE,
        "forecast_timestamp",
        "hours_ahead",
        "hours_ahead_interval",
        *TEMPERATURES,
        *WEATHER,
        DIRECTION,
        "weather_condition",
        "precipitation_probability",
        "forecast_created_at",
        "source_changed_at",
        PROCESSED_NOW,
    )
