"""Joins of the models: city by position, and forecasts with what was observed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import exact


def enrich_city(rows: DataFrame, cities: DataFrame, dedupe_dimension: bool = False) -> DataFrame:
    """City and country of a position that agrees to two decimals; no match gives NULL.

    A position listed twice doubles its rows, unless ``dedupe_dimension`` is set.  Spark sends the
    dimension to all executors only below its broadcast threshold; beyond that both sides are
    shuffled on the position, and adaptive execution splits a position that holds too many rows.
    """
    place = lambda x: f"round({exact(x)}, 2)"
    dimension = cities.selectExpr(f"{place('latitude')} AS _lat", f"{place('longitude')} AS _lon", "city", "country")
    if dedupe_dimension:
        dimension = dimension.dropDuplicates(["_lat", "_lon"])
    same_place = F.expr(f"{place('latitude')} = _lat AND {place('longitude')} = _lon")
    return rows.join(dimension, same_place, "left").drop("_lat", "_lon")


def actual_values(observations: DataFrame) -> DataFrame:
    """What was observed per city and time: the mean over all providers."""
    return observations.groupBy("city", "observation_time").agg(
        F.expr("avg(temperature_celsius) AS actual_temperature"),
        F.expr("avg(humidity_percent) AS actual_humidity"),
        F.expr("avg(wind_speed_ms) AS actual_wind_speed"),
        F.expr("count(DISTINCT provider) AS providers_count"),
    )


def forecast_errors(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Forecasts joined on city and exact time with what was observed, and their errors."""
    f = forecasts.selectExpr(
        "city",
        "provider",
        "hours_ahead_interval",
        "forecast_timestamp",
        "temperature_celsius AS forecast_temperature",
        "humidity_percent AS forecast_humidity",
        "wind_speed_ms AS forecast_wind_speed",
    )
    a = actuals.withColumnRenamed("observation_time", "forecast_timestamp").drop("providers_count")
    return (
        f.join(a, ["city", "forecast_timestamp"])
        .filter("actual_temperature IS NOT NULL")
        .selectExpr(
            "*",
            "abs(forecast_temperature - actual_temperature) AS temperature_error_abs",
            "abs(forecast_humidity - actual_humidity) AS humidity_error_abs",
            "abs(forecast_wind_speed - actual_wind_speed) AS wind_speed_error_abs",
            "power(forecast_temperature - actual_temperature, 2) AS temperature_squared_error",
            "power(forecast_humidity - actual_humidity, 2) AS humidity_squared_error",
        )
    )
