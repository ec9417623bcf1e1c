"""The declared checks of every layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.anomalies import run_anomalies
from ..operators.quality import Check, run_checks
from ..schemas import COMPASS_NAMES, FORECAST_PROVIDERS, LEAD_HOURS, PROVIDERS


def _not_null(model: str, *columns: str, severity: str = "error") -> list[Check]:
    return [Check(model, c, "not_null", severity) for c in columns]


def _unique(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "unique") for c in columns]


def _accepted(model: str, column: str, values, severity: str = "error") -> Check:
    return Check(model, column, "accepted_values", severity, values=tuple(values))


def _holds(model: str, column: str, expression: str, severity: str, where: str | None = None) -> Check:
    return Check(model, column, "expression", severity, expression=expression, where=where)


_DATED = ["latitude", "longitude", "created_at", "updated_at", "valid_from_dttm", "valid_to_dttm"]


def raw_checks() -> list[Check]:
    current, forecast = "raw.weather_current", "raw.weather_forecast"
    return [
        *_not_null(current, "id", "weather_id", *_DATED),
        *_unique(current, "id"),
        *_not_null(forecast, "id", "forecast_id", "hours", *_DATED),
        *_unique(forecast, "id"),
    ]


def stg_checks(forecast_providers=FORECAST_PROVIDERS) -> list[Check]:
    current, forecast = "stg.weather_current", "stg.weather_forecast"
    return [
        *_not_null(
            current, "weather_id", "city", "provider", "observation_time", "temperature_celsius"
        ),
        *_not_null(current, "country", severity="warn"),
        _accepted(current, "provider", PROVIDERS),
        _holds(current, "temperature_celsius", "between -100 and 60", "warn"),
        _holds(current, "humidity_percent", "between 0 and 100", "warn", "humidity_percent is not null"),
        *_not_null(
            forecast, "forecast_id", "city", "provider", "forecast_timestamp", "hours_ahead", "temperature_celsius"
        ),
        _accepted(forecast, "provider", forecast_providers),
        _holds(forecast, "hours_ahead", "between 0 and 200", "warn"),
        _holds(forecast, "temperature_celsius", "between -100 and 60", "warn"),
    ]


def ods_checks(forecast_providers=FORECAST_PROVIDERS) -> list[Check]:
    seen, forecast = "ods.weather_observations", "ods.weather_forecasts"
    return [
        *_unique(seen, "observation_id"),
        *_not_null(seen, "observation_id", "city", "provider", "observation_time", "temperature_celsius"),
        Check(seen, "city", "relationships", "warn", parent=forecast, parent_column="city"),
        _accepted(seen, "provider", PROVIDERS),
        _accepted(seen, "wind_direction_cardinal", COMPASS_NAMES, "warn"),
        *_unique(forecast, "forecast_id"),
        *_not_null(forecast, "forecast_id", "city", "provider", "hours_ahead_interval", "temperature_celsius"),
        _accepted(forecast, "provider", forecast_providers),
        _accepted(forecast, "hours_ahead_interval", LEAD_HOURS),
    ]


def dm_checks() -> list[Check]:
    accuracy, ranking, city = "dm.forecast_accuracy", "dm.provider_ranking", "dm.city_summary"
    return [
        *_not_null(accuracy, "provider", "hours_ahead_interval", "total_forecasts"),
        _accepted(accuracy, "hours_ahead_interval", LEAD_HOURS),
        _holds(accuracy, "total_forecasts", "> 0", "error"),
        *_not_null(accuracy, "temperature_mae", severity="warn"),
        _holds(accuracy, "temperature_mae", ">= 0", "warn"),
        _holds(accuracy, "accuracy_within_2deg_pct", "between 0 and 100", "warn"),
        *_unique(ranking, "provider", "overall_rank"),
        *_not_null(ranking, "provider", "overall_rank", "total_forecasts_all_intervals"),
        *_not_null(ranking, "avg_temperature_mae", severity="warn"),
        _holds(ranking, "avg_temperature_mae", ">= 0", "warn"),
        _holds(ranking, "total_forecasts_all_intervals", "> 0", "error"),
        *_unique(city, "city"),
        *_not_null(city, "city", "country", "days_tracked"),
        _holds(city, "days_tracked", "> 0", "error"),
        *_not_null(city, "providers_count", severity="warn"),
        _holds(city, "providers_count", "> 0", "warn"),
    ]


def all_checks(forecast_providers=FORECAST_PROVIDERS) -> list[Check]:
    return [*raw_checks(), *stg_checks(forecast_providers), *ods_checks(forecast_providers), *dm_checks()]


def anomaly_results(scores: DataFrame, history: DataFrame) -> DataFrame:
    """The declared anomaly checks as result rows like those of :func:`run_checks`; they only warn.

    ``scores`` are those kept of the observations.  A mart carries the stamp of its last build alone, so its metrics are
    compared over the runs in ``history``.
    """
    seen, mart = "ods.weather_observations", "dm.forecast_accuracy"
    runs = run_anomalies(history)
    named = [(f"{kind}_anomalies", seen, scores.filter(F.col("kind") == kind)) for kind in ("freshness", "volume", "dimension", "column")]
    named += [
        ("all_columns_anomalies", mart, runs.filter("metric <> 'lag'")),
        ("event_freshness_anomalies", mart, runs.filter("metric = 'lag'")),
    ]
    results = None
    for kind, model, scored in named:
        failures = scored.agg(F.count_if("is_anomaly").alias("failures"))
        one = failures.select(
            F.lit(f"{kind}_{model}").alias("check"),
            F.lit(model).alias("model"),
            F.lit(None).cast("string").alias("column"),
            F.lit("warn").alias("severity"),
            "failures",
            F.when(F.col("failures") > 0, "warn").otherwise("pass").alias("status"),
        )
        results = one if results is None else results.unionByName(one)
    return results


def check_layers(
    models: Mapping[str, DataFrame], scores: DataFrame, history: DataFrame, forecast_providers=FORECAST_PROVIDERS
) -> DataFrame:
    return run_checks(models, all_checks(forecast_providers)).unionByName(anomaly_results(scores, history))
