"""Queries for the operational models, the marts and their operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import day_of
from ..functions.metrics import avg_where, mae, pct_within, rmse
from ..functions.scalar import bucket_horizon, c_to_f, pg_round, ratio, surrogate_key, wind_cardinal
from ..operators.matching import actual_values, forecast_errors
from ..operators.medians import grouped_median
from ..plans import dm, ods
from ..session import written
from . import adapters as A
from .duck import ODS_FC_COLUMNS, ODS_OBS_COLUMNS, bucket, cardinal, key, r, sql, within
from .duck import c_to_f as duck_c_to_f
from .registry import query


def _observations(spark, sf_dir):
    return ods.ods_observations(A.observations(spark, sf_dir))


def _forecasts(spark, sf_dir):
    return ods.ods_forecasts(A.forecasts(spark, sf_dir))


def _errors(spark, sf_dir):
    return forecast_errors(_forecasts(spark, sf_dir), actual_values(_observations(spark, sf_dir)))


def _accuracy(spark, sf_dir):
    return dm.dm_forecast_accuracy(_observations(spark, sf_dir), _forecasts(spark, sf_dir))


# Functions and filters


@query(
    "fn_coalesce_changed_at",
    sql(
        """SELECT id, coalesce(updated_at, created_at, observation_time) AS source_changed_at FROM obs""",
        "obs",
    ),
)
def fn_coalesce_changed_at(spark, sf_dir):
    return A.observations(spark, sf_dir).selectExpr("id", f"{ods.OBSERVATION_CHANGED_AT} AS source_changed_at")


@query("flt_horizon_range", sql("SELECT id, hours_ahead FROM fc WHERE hours_ahead BETWEEN 0 AND 48", "fc"))
def flt_horizon_range(spark, sf_dir):
    return A.forecasts(spark, sf_dir).filter(F.col("hours_ahead").between(0, 48)).select("id", "hours_ahead")


@query("bucket_horizon", sql(f"SELECT id, hours_ahead, {bucket('hours_ahead')} AS hours_ahead_interval FROM fc", "fc"))
def bucket_horizon_query(spark, sf_dir):
    at = f"{bucket_horizon('hours_ahead')} AS hours_ahead_interval"
    return A.forecasts(spark, sf_dir).selectExpr("id", "hours_ahead", at)


@query(
    "flt_bucket_not_null",
    sql(
        f"""SELECT id, {bucket("hours_ahead")} AS hours_ahead_interval FROM fc
        WHERE hours_ahead BETWEEN 0 AND 48 AND {bucket("hours_ahead")} IS NOT NULL""",
        "fc",
    ),
)
def flt_bucket_not_null(spark, sf_dir):
    return ods.with_lead_time(A.forecasts(spark, sf_dir)).select("id", "hours_ahead_interval")


@query("dedup_latest_obs", sql("SELECT city, provider, observation_time, id, source_changed_at FROM ods_obs", "ods_obs"))
def dedup_latest_obs(spark, sf_dir):
    changed = A.observations(spark, sf_dir).selectExpr("*", f"{ods.OBSERVATION_CHANGED_AT} AS source_changed_at")
    return ods.latest_observations(changed).select("city", "provider", "observation_time", "id", "source_changed_at")


@query(
    "dedup_latest_fc",
    sql("SELECT city, provider, forecast_timestamp, hours_ahead_interval, id, source_changed_at FROM ods_fc", "ods_fc"),
)
def dedup_latest_fc(spark, sf_dir):
    changed = A.forecasts(spark, sf_dir).selectExpr("*", f"{ods.FORECAST_CHANGED_AT} AS source_changed_at")
    return ods.latest_forecasts(ods.with_lead_time(changed)).select(*ods.FORECAST_KEY, "id", "source_changed_at")


@query(
    "key_surrogate",
    sql(f"SELECT id, {key('city', 'provider', 'observation_time', 'updated_at')} AS digest FROM obs", "obs"),
)
def key_surrogate(spark, sf_dir):
    digest = surrogate_key("city", "provider", "observation_time", "updated_at")
    return A.observations(spark, sf_dir).selectExpr("id", f"{digest} AS digest")


@query("fn_c_to_f", sql(f"SELECT id, {duck_c_to_f('temperature_celsius')} AS fahrenheit FROM obs", "obs"))
def fn_c_to_f(spark, sf_dir):
    return A.observations(spark, sf_dir).selectExpr("id", f"{c_to_f('temperature_celsius')} AS fahrenheit")


@query("fn_wind_cardinal", sql(f"SELECT id, {cardinal('wind_direction_degrees')} AS cardinal FROM obs", "obs"))
def fn_wind_cardinal(spark, sf_dir):
    return A.observations(spark, sf_dir).selectExpr("id", f"{wind_cardinal('wind_direction_degrees')} AS cardinal")


@query("ods_observations", sql(f"SELECT {ODS_OBS_COLUMNS} FROM ods_obs", "ods_obs"))
def ods_observations(spark, sf_dir):
    return _observations(spark, sf_dir).drop("processed_dttm")


@query("ods_forecasts", sql(f"SELECT {ODS_FC_COLUMNS} FROM ods_fc", "ods_fc"))
def ods_forecasts(spark, sf_dir):
    return _forecasts(spark, sf_dir).drop("processed_dttm")


# Joins and projections

_ROUNDED = ["actual_temperature", "actual_humidity", "actual_wind_speed"]


@query(
    "preagg_actuals",
    sql(
        f"""SELECT city, observation_time, {", ".join(f"{r(c, 6)} AS {c}" for c in _ROUNDED)}, providers_count
        FROM actuals""",
        "actuals",
    ),
)
def preagg_actuals(spark, sf_dir):
    return actual_values(_observations(spark, sf_dir)).withColumns({c: F.expr(pg_round(c, 6)) for c in _ROUNDED})


@query(
    "join_forecast_actual",
    sql(
        f"""SELECT city, provider, forecast_timestamp, hours_ahead_interval, forecast_temperature,
            {r("actual_temperature", 6)} AS actual_temperature FROM errors""",
        "errors",
    ),
)
def join_forecast_actual(spark, sf_dir):
    return _errors(spark, sf_dir).selectExpr(
        *ods.FORECAST_KEY, "forecast_temperature", f"{pg_round('actual_temperature', 6)} AS actual_temperature"
    )


_ABS = ["temperature_error_abs", "humidity_error_abs", "wind_speed_error_abs"]
_SQUARED = ["temperature_squared_error", "humidity_squared_error"]


@query(
    "fn_abs_error",
    sql(
        f"""SELECT city, provider, forecast_timestamp, hours_ahead_interval,
        {", ".join(f"{r(c, 6)} AS {c}" for c in _ABS)} FROM errors""",
        "errors",
    ),
)
def fn_abs_error(spark, sf_dir):
    return _errors(spark, sf_dir).selectExpr(*ods.FORECAST_KEY, *[f"{pg_round(c, 6)} AS {c}" for c in _ABS])


@query(
    "fn_sq_error",
    sql(
        f"""SELECT city, provider, forecast_timestamp, hours_ahead_interval,
        {", ".join(f"{r(c, 4)} AS {c}" for c in _SQUARED)} FROM errors""",
        "errors",
    ),
)
def fn_sq_error(spark, sf_dir):
    return _errors(spark, sf_dir).selectExpr(*ods.FORECAST_KEY, *[f"{pg_round(c, 4)} AS {c}" for c in _SQUARED])


@query(
    "fn_range",
    sql(
        f"""SELECT city, {r("max(temperature_celsius) - min(temperature_celsius)", 6)} AS temperature_range
        FROM ods_obs GROUP BY city""",
        "ods_obs",
    ),
)
def fn_range(spark, sf_dir):
    span = pg_round("max(temperature_celsius) - min(temperature_celsius)", 6)
    return _observations(spark, sf_dir).groupBy("city").agg(F.expr(f"{span} AS temperature_range"))


@query(
    "fn_ratio_nullif",
    sql(
        """SELECT city, provider, CAST(count(*) AS DOUBLE) / nullif(count(*) FILTER (WHERE humidity_percent > 90), 0) AS ratio
        FROM obs GROUP BY city, provider""",
        "obs",
    ),
)
def fn_ratio_nullif(spark, sf_dir):
    counts = A.observations(spark, sf_dir).groupBy("city", "provider").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("humidity_percent") > 90).alias("humid")
    )
    return counts.selectExpr("city", "provider", f"{ratio('n', 'humid')} AS ratio")


@query(
    "sort_output",
    sql("SELECT provider, hours_ahead_interval, total_forecasts FROM accuracy ORDER BY provider, hours_ahead_interval", "accuracy"),
)
def sort_output(spark, sf_dir):
    accuracy = _accuracy(spark, sf_dir).select(*dm.ACCURACY_KEY, "total_forecasts")
    return accuracy.orderBy(*dm.ACCURACY_KEY)


# Aggregations


@query("agg_count", sql("SELECT provider, count(*) AS n, count(humidity_percent) AS known FROM obs GROUP BY provider", "obs"))
def agg_count(spark, sf_dir):
    return A.observations(spark, sf_dir).groupBy("provider").agg(
        F.count(F.lit(1)).alias("n"), F.count("humidity_percent").alias("known")
    )


@query(
    "agg_count_distinct",
    sql(
        """SELECT city, country, count(DISTINCT provider) AS providers, count(DISTINCT observation_time) AS times,
            count(*) AS n, max(temperature_celsius) AS warmest FROM obs GROUP BY city, country""",
        "obs",
    ),
)
def agg_count_distinct(spark, sf_dir):
    return A.observations(spark, sf_dir).groupBy("city", "country").agg(
        F.count_distinct("provider").alias("providers"),
        F.count_distinct("observation_time").alias("times"),
        F.count(F.lit(1)).alias("n"),
        F.max("temperature_celsius").alias("warmest"),
    )


@query(
    "agg_distinct_days",
    sql("SELECT city, count(DISTINCT date_trunc('day', observation_time)) AS days_tracked FROM obs GROUP BY city", "obs"),
)
def agg_distinct_days(spark, sf_dir):
    days = F.expr(f"count(DISTINCT {day_of('observation_time')}) AS days_tracked")
    return A.observations(spark, sf_dir).groupBy("city").agg(days)


@query(
    "agg_avg_min_max_sum",
    sql(
        f"""SELECT city, {r("avg(temperature_celsius)", 6)} AS mean, min(temperature_celsius) AS lowest,
            max(temperature_celsius) AS highest, {r("sum(precipitation_mm)", 6)} AS total,
            min(observation_time) AS first_time, max(observation_time) AS last_time FROM obs GROUP BY city""",
        "obs",
    ),
)
def agg_avg_min_max_sum(spark, sf_dir):
    return A.observations(spark, sf_dir).groupBy("city").agg(
        F.expr(f"{pg_round('avg(temperature_celsius)', 6)} AS mean"),
        F.min("temperature_celsius").alias("lowest"),
        F.max("temperature_celsius").alias("highest"),
        F.expr(f"{pg_round('sum(precipitation_mm)', 6)} AS total"),
        F.min("observation_time").alias("first_time"),
        F.max("observation_time").alias("last_time"),
    )


@query(
    "agg_stddev",
    sql(
        f"""SELECT city, provider, observation_time, {r("stddev_samp(temperature_celsius)", 6)} AS stddev
        FROM obs GROUP BY city, provider, observation_time""",
        "obs",
    ),
)
def agg_stddev(spark, sf_dir):
    # Most of these groups have one row, whose deviation is NULL.
    deviation = F.expr(f"{pg_round('stddev_samp(temperature_celsius)', 6)} AS stddev")
    return A.observations(spark, sf_dir).groupBy(*ods.OBSERVATION_KEY).agg(deviation)


@query(
    "agg_mae",
    sql(
        f"""SELECT provider, {r("avg(temperature_error_abs)", 2)} AS temperature_mae,
            {r("avg(humidity_error_abs)", 2)} AS humidity_mae, {r("avg(wind_speed_error_abs)", 2)} AS wind_speed_mae
        FROM errors GROUP BY provider""",
        "errors",
    ),
)
def agg_mae(spark, sf_dir):
    return _errors(spark, sf_dir).groupBy("provider").agg(
        F.expr(f"{mae('temperature_error_abs')} AS temperature_mae"),
        F.expr(f"{mae('humidity_error_abs')} AS humidity_mae"),
        F.expr(f"{mae('wind_speed_error_abs')} AS wind_speed_mae"),
    )


@query(
    "agg_rmse",
    sql(
        f"""SELECT provider, {r("sqrt(avg(temperature_squared_error))", 2)} AS temperature_rmse,
            {r("sqrt(avg(humidity_squared_error))", 2)} AS humidity_rmse FROM errors GROUP BY provider""",
        "errors",
    ),
)
def agg_rmse(spark, sf_dir):
    return _errors(spark, sf_dir).groupBy("provider").agg(
        F.expr(f"{rmse('temperature_squared_error')} AS temperature_rmse"),
        F.expr(f"{rmse('humidity_squared_error')} AS humidity_rmse"),
    )


@query(
    "agg_median",
    sql(
        f"""SELECT provider, hours_ahead_interval, {r("quantile_cont(temperature_error_abs, 0.5)", 6)} AS median_error
        FROM errors GROUP BY provider, hours_ahead_interval""",
        "errors",
    ),
)
def agg_median(spark, sf_dir):
    errors = written(_errors(spark, sf_dir).select(*dm.ACCURACY_KEY, "temperature_error_abs"))
    medians = grouped_median(errors, dm.ACCURACY_KEY, "temperature_error_abs", "median_error")
    return medians.withColumn("median_error", F.expr(pg_round("median_error", 6)))


@query(
    "agg_median_two_pass",
    sql(
        """SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.5) AS median_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus"""
    ),
)
def agg_median_two_pass(spark, sf_dir):
    """The median for groups too large for one task, on a coarse sketch so that both passes count."""
    lines = A.table(spark, sf_dir, "lineitem")
    return grouped_median(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price", accuracy=1000)


@query(
    "agg_max_error",
    sql(f"SELECT provider, {r('max(temperature_error_abs)', 2)} AS temperature_max_error FROM errors GROUP BY provider", "errors"),
)
def agg_max_error(spark, sf_dir):
    worst = F.expr(f"{pg_round('max(temperature_error_abs)', 2)} AS temperature_max_error")
    return _errors(spark, sf_dir).groupBy("provider").agg(worst)


@query(
    "agg_pct_within",
    sql(
        f"""SELECT provider, {within("temperature_error_abs", 2)} AS within_2deg,
            {within("temperature_error_abs", 5)} AS within_5deg, {within("humidity_error_abs", 10)} AS within_10pct
        FROM errors GROUP BY provider""",
        "errors",
    ),
)
def agg_pct_within(spark, sf_dir):
    return _errors(spark, sf_dir).groupBy("provider").agg(
        F.expr(f"{pct_within('temperature_error_abs', 2)} AS within_2deg"),
        F.expr(f"{pct_within('temperature_error_abs', 5)} AS within_5deg"),
        F.expr(f"{pct_within('humidity_error_abs', 10)} AS within_10pct"),
    )


@query(
    "agg_conditional_avg",
    sql(
        f"""SELECT provider, {r("avg(temperature_error_abs) FILTER (WHERE hours_ahead_interval <= 6)", 6)} AS short_term,
            {r("avg(temperature_error_abs) FILTER (WHERE hours_ahead_interval >= 12)", 6)} AS long_term
        FROM errors GROUP BY provider""",
        "errors",
    ),
)
def agg_conditional_avg(spark, sf_dir):
    short = avg_where("temperature_error_abs", "hours_ahead_interval <= 6")
    long = avg_where("temperature_error_abs", "hours_ahead_interval >= 12")
    return _errors(spark, sf_dir).groupBy("provider").agg(
        F.expr(f"{pg_round(short, 6)} AS short_term"), F.expr(f"{pg_round(long, 6)} AS long_term")
    )


_ROLLED = [
    "avg_temperature_mae",
    "avg_temperature_rmse",
    "avg_accuracy_2deg",
    "avg_accuracy_5deg",
    "avg_humidity_mae",
    "avg_wind_speed_mae",
    "short_term_temperature_mae",
    "short_term_accuracy_2deg",
    "long_term_temperature_mae",
    "long_term_accuracy_2deg",
]


@query(
    "agg_provider_rollup",
    sql(
        f"""SELECT provider, {", ".join(f"{r(c, 6)} AS {c}" for c in _ROLLED)}, total_forecasts_all_intervals
        FROM rollup""",
        "rollup",
    ),
)
def agg_provider_rollup(spark, sf_dir):
    return dm.provider_rollup(_accuracy(spark, sf_dir)).withColumns({c: F.expr(pg_round(c, 6)) for c in _ROLLED})


# Ranks

_RANKS = ["rank_by_temperature_mae", "rank_by_accuracy_2deg", "rank_short_term", "rank_long_term"]


@query("rank_by_metric", sql(f"SELECT provider, {', '.join(_RANKS)} FROM ranked", "ranked"))
def rank_by_metric(spark, sf_dir):
    return dm.rank_providers(dm.provider_rollup(_accuracy(spark, sf_dir))).select("provider", *_RANKS)


@query("rank_composite", sql("SELECT provider, CAST(overall_rank_score AS DOUBLE) AS overall_rank_score FROM ranked", "ranked"))
def rank_composite(spark, sf_dir):
    ranked = dm.rank_providers(dm.provider_rollup(_accuracy(spark, sf_dir)))
    return ranked.select("provider", "overall_rank_score")


@query("rank_overall", sql("SELECT provider, overall_rank, overall_rank_score FROM ranking", "ranking"))
def rank_overall(spark, sf_dir):
    return dm.dm_provider_ranking(_accuracy(spark, sf_dir)).select("provider", "overall_rank", "overall_rank_score")


# Marts and the queries read from them

_SUMMARY = """city, country, latitude, longitude, first_observation, last_observation, days_tracked,
    total_observations, providers_count, avg_observations_per_day, avg_temperature, min_temperature,
    max_temperature, stddev_temperature, temperature_range, avg_humidity, min_humidity, max_humidity,
    avg_wind_speed, max_wind_speed, avg_precipitation, total_precipitation"""


@query("dm_forecast_accuracy", sql("SELECT * FROM accuracy", "accuracy"))
def dm_forecast_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir).drop("dbt_updated_at")


@query("dm_provider_ranking", sql("SELECT * FROM ranking", "ranking"))
def dm_provider_ranking(spark, sf_dir):
    return dm.dm_provider_ranking(_accuracy(spark, sf_dir)).drop("dbt_updated_at")


@query("dm_city_summary", sql(f"SELECT {_SUMMARY} FROM summary", "summary"))
def dm_city_summary(spark, sf_dir):
    return dm.dm_city_summary(_observations(spark, sf_dir)).drop("dbt_updated_at")


@query(
    "q_accuracy_dashboard",
    sql("SELECT * FROM accuracy WHERE hours_ahead_interval IN (1, 3, 6, 12, 24) ORDER BY provider, hours_ahead_interval", "accuracy"),
)
def q_accuracy_dashboard(spark, sf_dir):
    return dm.accuracy_dashboard(_accuracy(spark, sf_dir)).drop("dbt_updated_at")


@query("q_ranking_dashboard", sql("SELECT * FROM ranking ORDER BY overall_rank", "ranking"))
def q_ranking_dashboard(spark, sf_dir):
    return dm.ranking_dashboard(dm.dm_provider_ranking(_accuracy(spark, sf_dir))).drop("dbt_updated_at")


@query(
    "q_city_dashboard",
    sql(f"SELECT {_SUMMARY} FROM summary WHERE days_tracked > 20 ORDER BY total_observations DESC, city", "summary"),
)
def q_city_dashboard(spark, sf_dir):
    return dm.city_dashboard(dm.dm_city_summary(_observations(spark, sf_dir)), min_days=20).drop("dbt_updated_at")
