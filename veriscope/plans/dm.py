"""Marts: accuracy by lead time, provider ranking, city summary, and the queries read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import day_of
from ..functions.metrics import avg_where, mae, pct_within, rmse
from ..functions.scalar import pg_round, ratio
from ..operators.matching import actual_values, forecast_errors
from ..operators.medians import grouped_median
from ..session import written

ACCURACY_KEY = ["provider", "hours_ahead_interval"]


UPDATED_NOW = "localtimestamp() AS dbt_updated_at"


def _aggregates(named: dict[str, str]) -> list[Column]:
    return [F.expr(f"{expression} AS {name}") for name, expression in named.items()]


def accuracy_of(errors: DataFrame) -> DataFrame:
    """Error metrics per provider and lead time.

    The errors are written once: the median is found in two passes over them, and all other
    metrics are plain partial aggregates.
    """
    errors = written(
        errors.select(
            *ACCURACY_KEY,
            "city",
            "temperature_error_abs",
            "humidity_error_abs",
            "wind_speed_error_abs",
            "temperature_squared_error",
            "humidity_squared_error",
        )
    )
    temperature, humidity = "temperature_error_abs", "humidity_error_abs"
    metrics = errors.groupBy(*ACCURACY_KEY).agg(
        *_aggregates(
            {
                "total_forecasts": "count(1)",
                "cities_count": "count(DISTINCT city)",
                "temperature_mae": mae(temperature),
                "temperature_rmse": rmse("temperature_squared_error"),
                "temperature_max_error": pg_round(f"max({temperature})", 2),
                "accuracy_within_2deg_pct": pct_within(temperature, 2),
                "accuracy_within_5deg_pct": pct_within(temperature, 5),
                "humidity_mae": mae(humidity),
                "humidity_rmse": rmse("humidity_squared_error"),
                "humidity_accuracy_within_10pct": pct_within(humidity, 10),
                "wind_speed_mae": mae("wind_speed_error_abs"),
            }
        )
    )
    medians = grouped_median(errors, ACCURACY_KEY, temperature, "_median")
    medians = medians.selectExpr(*[f"{k} AS _{k}" for k in ACCURACY_KEY], "_median")
    same = " AND ".join(f"{k} <=> _{k}" for k in ACCURACY_KEY)
    metrics = metrics.join(medians, F.expr(same), "left")
    return metrics.selectExpr(*_accuracy_columns())


# Accuracy from day partials: a day's partials depend on that day alone, so a run makes only those of changed days.

PART_TIME = "part_time"
ACCURACY_PARTS = ("parts.accuracy", "parts.accuracy_errors")
BINS = 256  # of the histogram, to a degree
LAST_BIN = 1 << 40  # of errors too large for one of their own


def errors_of(observations: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Errors of forecasts with the time they are for."""
    return forecast_errors(forecasts, actual_values(observations))


def accuracy_parts(errors: DataFrame) -> dict[str, DataFrame]:
    """What the accuracy of a day's forecasts adds up from, per provider and lead time.

    Counts, sums and maxima, with the cities and a histogram of the temperature errors (as many entries as there are cities and
    bins); and these errors themselves, sorted, of which the median will read those of one bin.  Both have the day as
    ``part_time``.
    """
    temperature = "temperature_error_abs"
    rows = written(
        errors.selectExpr(
            f"{day_of('forecast_timestamp')} AS {PART_TIME}",
            *ACCURACY_KEY,
            "city",
            temperature,
            "humidity_error_abs",
            "wind_speed_error_abs",
            "temperature_squared_error",
            "humidity_squared_error",
        )
    )
    key = [PART_TIME, *ACCURACY_KEY]
    both = lambda name, x: {f"{name}_n": f"count({x})", f"{name}_sum": f"sum({x})"}
    sums = rows.groupBy(*key).agg(
        *_aggregates(
            {
                "n": "count(1)",
                **both("t", temperature),
                **both("tt", "temperature_squared_error"),
                **both("h", "humidity_error_abs"),
                **both("hh", "humidity_squared_error"),
                **both("w", "wind_speed_error_abs"),
                "t_max": f"max({temperature})",
                "within_2": f"count_if({temperature} <= 2.0D)",
                "within_5": f"count_if({temperature} <= 5.0D)",
                "humid_within_10": "count_if(humidity_error_abs <= 10.0D)",
                "cities": "collect_set(city)",
            }
        )
    )
    of_bin = f"CASE WHEN {temperature} < {LAST_BIN // BINS} THEN cast(floor({temperature} * {BINS}) AS bigint) ELSE {LAST_BIN} END"
    known = rows.filter(f"{temperature} IS NOT NULL").selectExpr(*key, f"{of_bin} AS bin", f"{temperature} AS error")
    # Equal errors are one row; sorted when written, so that a reader of one bin skips most of a file.
    values = written(known.groupBy(*key, "bin", "error").agg(F.count(F.lit(1)).alias("n")))
    bins = values.groupBy(*key, "bin").agg(F.sum("n").alias("n"))
    bins = bins.groupBy(*key).agg(F.collect_list(F.struct("bin", "n")).alias("bins"))
    named = bins.withColumnsRenamed({k: f"_{k}" for k in key})
    same = F.expr(" AND ".join(f"{k} <=> _{k}" for k in key))
    sums = sums.join(named, same, "left").drop(*(f"_{k}" for k in key))
    return dict(zip(ACCURACY_PARTS, (sums, values), strict=True))


def _same_group(other: str = "_") -> Column:
    return F.expr(" AND ".join(f"{k} <=> {other}{k}" for k in ACCURACY_KEY))


def _renamed_key(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({k: f"_{k}" for k in ACCURACY_KEY})


def _median_of_parts(sums: DataFrame, values: DataFrame) -> DataFrame:
    """The exact median per group: the histogram tells the bins of the two middle ranks, the values inside are ranked."""
    counts = sums.select(*ACCURACY_KEY, F.inline("bins")).groupBy(*ACCURACY_KEY, "bin").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*ACCURACY_KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*ACCURACY_KEY)
    middle = F.expr("(_all - 1) div 2"), F.expr("_all div 2")
    placed = counts.withColumn("_end", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(whole))
    holds = placed.filter((F.col("_end") > middle[0]) & (F.col("_end") - F.col("n") <= middle[1]))
    holds = written(holds.select(*(F.col(k).alias(f"_{k}") for k in ACCURACY_KEY), F.col("bin").alias("_bin"), "_end", "n", "_all"))
    ends = holds.agg(F.min("_bin"), F.max("_bin")).first()  # of all groups, so that files are skipped
    if ends[0] is None:
        return values.select(*ACCURACY_KEY, F.col("error").alias("_median")).limit(0)
    near = values.filter(F.col("bin").between(*ends)).join(
        holds.withColumnRenamed("n", "_held"), _same_group() & (F.col("bin") == F.col("_bin"))
    )
    near = near.groupBy(*ACCURACY_KEY, "bin", "error", "_end", "_held", "_all").agg(F.sum("n").alias("n"))
    inside = Window.partitionBy(*ACCURACY_KEY, "bin").orderBy("error").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = near.withColumn("_to", F.col("_end") - F.col("_held") + F.sum("n").over(inside))
    at = lambda rank: F.min(F.when(F.col("_to") > rank, F.col("error")))
    halves = at(middle[0]) * F.lit(0.5) + at(middle[1]) * F.lit(0.5)
    return ranked.groupBy(*ACCURACY_KEY).agg(halves.alias("_median"))


def accuracy_from_parts(sums: DataFrame, values: DataFrame) -> DataFrame:
    """:func:`dm_forecast_accuracy` from the day partials of all days."""
    mean = lambda name: f"sum({name}_sum) / nullif(sum({name}_n), 0)"
    share = lambda name: pg_round(f"cast(sum({name}) AS double) / sum(n) * 100.0D", 1)
    total = sums.groupBy(*ACCURACY_KEY).agg(
        *_aggregates(
            {
                "total_forecasts": "sum(n)",
                "temperature_mae": pg_round(mean("t"), 2),
                "temperature_rmse": pg_round(f"sqrt({mean('tt')})", 2),
                "temperature_max_error": pg_round("max(t_max)", 2),
                "accuracy_within_2deg_pct": share("within_2"),
                "accuracy_within_5deg_pct": share("within_5"),
                "humidity_mae": pg_round(mean("h"), 2),
                "humidity_rmse": pg_round(f"sqrt({mean('hh')})", 2),
                "humidity_accuracy_within_10pct": share("humid_within_10"),
                "wind_speed_mae": pg_round(mean("w"), 2),
            }
        )
    )
    seen = sums.select(*ACCURACY_KEY, F.explode("cities").alias("city")).distinct()
    counted = seen.groupBy(*ACCURACY_KEY).agg(F.count("city").alias("cities_count"))
    total = total.join(_renamed_key(counted), _same_group(), "left").drop(*(f"_{k}" for k in ACCURACY_KEY))
    total = total.withColumn("cities_count", F.coalesce("cities_count", F.lit(0)))
    total = total.join(_renamed_key(_median_of_parts(sums, values)), _same_group(), "left")
    return total.selectExpr(*_accuracy_columns())


def _accuracy_columns() -> list[str]:
    return [
        *ACCURACY_KEY,
        "total_forecasts",
        "cities_count",
        "temperature_mae",
        "temperature_rmse",
        f"{pg_round('_median', 2)} AS temperature_median_error",
        "temperature_max_error",
        "accuracy_within_2deg_pct",
        "accuracy_within_5deg_pct",
        "humidity_mae",
        "humidity_rmse",
        "humidity_accuracy_within_10pct",
        "wind_speed_mae",
        UPDATED_NOW,
    ]


def dm_forecast_accuracy(observations: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Accuracy of each provider at each lead time: 15 columns."""
    return accuracy_of(errors_of(observations, forecasts))


def provider_rollup(accuracy: DataFrame) -> DataFrame:
    """Per provider: unweighted means over its lead times, also over short and long ones alone."""
    short, long = "hours_ahead_interval <= 6", "hours_ahead_interval >= 12"
    error, share = "temperature_mae", "accuracy_within_2deg_pct"
    return accuracy.groupBy("provider").agg(
        *_aggregates(
            {
                "avg_temperature_mae": f"avg({error})",
                "avg_temperature_rmse": "avg(temperature_rmse)",
                "avg_accuracy_2deg": f"avg({share})",
                "avg_accuracy_5deg": "avg(accuracy_within_5deg_pct)",
                "avg_humidity_mae": "avg(humidity_mae)",
                "avg_wind_speed_mae": "avg(wind_speed_mae)",
                "short_term_temperature_mae": avg_where(error, short),
                "short_term_accuracy_2deg": avg_where(share, short),
                "long_term_temperature_mae": avg_where(error, long),
                "long_term_accuracy_2deg": avg_where(share, long),
                "total_forecasts_all_intervals": "sum(total_forecasts)",
            }
        )
    )


def _place(metric: str, order: str = "ASC NULLS LAST") -> str:
    """Position over all providers, one row each; equal values are settled by name.

    Metrics are ranked at nine decimals, so that the last bit of a mean does not decide.
    """
    return f"row_number() OVER (ORDER BY {pg_round(metric, 9)} {order}, provider ASC NULLS LAST)"


def rank_providers(rollup: DataFrame) -> DataFrame:
    """Four ranks per provider and the mean of four metric ranks."""
    error = _place("avg_temperature_mae")
    # An unknown share comes first, as it does in a plain descending order of the marts' dialect.
    share = _place("avg_accuracy_2deg", "DESC NULLS FIRST")
    four = " + ".join([error, share, _place("avg_humidity_mae"), _place("avg_wind_speed_mae")])
    return rollup.selectExpr(
        "*",
        f"{error} AS rank_by_temperature_mae",
        f"{share} AS rank_by_accuracy_2deg",
        f"{_place('short_term_temperature_mae')} AS rank_short_term",
        f"{_place('long_term_temperature_mae')} AS rank_long_term",
        f"({four}) / 4.0D AS overall_rank_score",
    )


def dm_provider_ranking(accuracy: DataFrame) -> DataFrame:
    """Ranking of the providers over all their metrics: 19 columns."""
    rounded = lambda name, digits, alias=None: f"{pg_round(name, digits)} AS {alias or name}"
    return rank_providers(provider_rollup(accuracy)).selectExpr(
        "provider",
        f"{_place('overall_rank_score')} AS overall_rank",
        rounded("overall_rank_score", 2),
        rounded("avg_temperature_mae", 2),
        rounded("avg_temperature_rmse", 2),
        rounded("avg_accuracy_2deg", 1, "avg_accuracy_2deg_pct"),
        rounded("avg_accuracy_5deg", 1, "avg_accuracy_5deg_pct"),
        rounded("avg_humidity_mae", 2),
        rounded("avg_wind_speed_mae", 2),
        rounded("short_term_temperature_mae", 2),
        rounded("short_term_accuracy_2deg", 1, "short_term_accuracy_2deg_pct"),
        rounded("long_term_temperature_mae", 2),
        rounded("long_term_accuracy_2deg", 1, "long_term_accuracy_2deg_pct"),
        "rank_by_temperature_mae",
        "rank_by_accuracy_2deg",
        "rank_short_term",
        "rank_long_term",
        "total_forecasts_all_intervals",
        UPDATED_NOW,
    )


def dm_city_summary(observations: DataFrame) -> DataFrame:
    """History of each city: 23 columns.

    Days and providers are counted over one row per city, provider and day, so no row is read more than
    once for the two distinct counts.
    """
    t, h, w, p = "temperature_celsius", "humidity_percent", "wind_speed_ms", "precipitation_mm"
    seen = observations.groupBy("city", "country", "provider", F.expr(f"{day_of('observation_time')} AS _day")).agg(F.lit(1))
    counts = seen.groupBy(F.col("city").alias("_city"), F.col("country").alias("_country")).agg(
        F.size(F.collect_set("_day")).cast("bigint").alias("days_tracked"),
        F.size(F.collect_set("provider")).cast("bigint").alias("providers_count"),
    )
    stats = observations.groupBy("city", "country").agg(
        *_aggregates(
            {
                "latitude": pg_round("avg(latitude)", 4),
                "longitude": pg_round("avg(longitude)", 4),
                "first_observation": "min(observation_time)",
                "last_observation": "max(observation_time)",
                "total_observations": "count(1)",
                "avg_temperature": pg_round(f"avg({t})", 1),
                "min_temperature": pg_round(f"min({t})", 1),
                "max_temperature": pg_round(f"max({t})", 1),
                "stddev_temperature": pg_round(f"stddev_samp({t})", 1),
                "avg_humidity": pg_round(f"avg({h})", 1),
                "min_humidity": pg_round(f"min({h})", 1),
                "max_humidity": pg_round(f"max({h})", 1),
                "avg_wind_speed": pg_round(f"avg({w})", 1),
                "max_wind_speed": pg_round(f"max({w})", 1),
                "avg_precipitation": pg_round(f"avg({p})", 2),
                "total_precipitation": pg_round(f"sum({p})", 2),
            }
        )
    )
    stats = stats.join(counts, F.expr("city <=> _city AND country <=> _country"))
    return stats.selectExpr(*_city_columns())


def _city_columns() -> list[str]:
    return [
        "city",
        "country",
        "latitude",
        "longitude",
        "first_observation",
        "last_observation",
        "days_tracked",
        "total_observations",
        "providers_count",
        f"{pg_round(ratio('total_observations', 'days_tracked'), 1)} AS avg_observations_per_day",
        "avg_temperature",
        "min_temperature",
        "max_temperature",
        "stddev_temperature",
        f"{pg_round('max_temperature - min_temperature', 1)} AS temperature_range",
        "avg_humidity",
        "min_humidity",
        "max_humidity",
        "avg_wind_speed",
        "max_wind_speed",
        "avg_precipitation",
        "total_precipitation",
        UPDATED_NOW,
    ]


CITY_PARTS = ("parts.city_days",)
_MEANS = {"la": "latitude", "lo": "longitude", "t": "temperature_celsius", "h": "humidity_percent", "w": "wind_speed_ms", "p": "precipitation_mm"}


def city_parts(observations: DataFrame) -> DataFrame:
    """What a city's summary adds up from: a row per city, provider and day (``part_time``).

    The spread of temperatures is kept as their number, mean and sum of squared deviations, which merge.
    """
    key = ["city", "country", "provider", F.expr(f"{day_of('observation_time')} AS {PART_TIME}")]
    named = {f"{short}_n": f"count({c})" for short, c in _MEANS.items()} | {f"{short}_sum": f"sum({c})" for short, c in _MEANS.items()}
    ends = {f"{short}_{end}": f"{end}({_MEANS[short]})" for short in "thw" for end in ("min", "max")}
    own = {"first": "min(observation_time)", "last": "max(observation_time)", "n": "count(1)"}
    deviations = {"t_squares": "var_pop(temperature_celsius) * count(temperature_celsius)"}
    return observations.groupBy(*key).agg(*_aggregates({**own, **named, **ends, **deviations}))


def city_from_parts(parts: DataFrame) -> DataFrame:
    """:func:`dm_city_summary` from the partials of all days."""
    mean = lambda short, digits: pg_round(f"sum({short}_sum) / nullif(sum({short}_n), 0)", digits)
    place = ["city", "country"]
    of_city = parts.groupBy(*place).agg(
        *_aggregates(
            {
                "latitude": mean("la", 4),
                "longitude": mean("lo", 4),
                "first_observation": "min(first)",
                "last_observation": "max(last)",
                "total_observations": "sum(n)",
                "days_tracked": f"count(DISTINCT {PART_TIME})",
                "providers_count": "count(DISTINCT provider)",
                "avg_temperature": mean("t", 1),
                "min_temperature": pg_round("min(t_min)", 1),
                "max_temperature": pg_round("max(t_max)", 1),
                "avg_humidity": mean("h", 1),
                "min_humidity": pg_round("min(h_min)", 1),
                "max_humidity": pg_round("max(h_max)", 1),
                "avg_wind_speed": mean("w", 1),
                "max_wind_speed": pg_round("max(w_max)", 1),
                "avg_precipitation": mean("p", 2),
                "total_precipitation": pg_round("sum(p_sum)", 2),
                "_mean": "sum(t_sum) / nullif(sum(t_n), 0)",
            }
        )
    )
    # Squared deviations from the city's mean: those from each part's own mean, and those of the parts' means.
    same = F.expr("city <=> _city AND country <=> _country")
    means = of_city.selectExpr("city AS _city", "country AS _country", "_mean")
    apart = "CASE WHEN t_n > 0 THEN t_squares + t_n * pow(t_sum / t_n - _mean, 2) END"
    spread = parts.join(means, same).groupBy("_city", "_country").agg(
        F.expr(f"CASE WHEN sum(t_n) > 1 THEN sqrt(sum({apart}) / (sum(t_n) - 1)) END AS _stddev")
    )
    rounded = of_city.join(spread, same).withColumn("stddev_temperature", F.expr(pg_round("_stddev", 1)))
    return rounded.selectExpr(*_city_columns())


def accuracy_dashboard(accuracy: DataFrame, intervals: Sequence[int] = (1, 3, 6, 12, 24)) -> DataFrame:
    return accuracy.filter(F.col("hours_ahead_interval").isin(*intervals)).orderBy(*ACCURACY_KEY)


def ranking_dashboard(ranking: DataFrame) -> DataFrame:
    return ranking.orderBy("overall_rank")


def city_dashboard(summary: DataFrame, min_days: int = 30) -> DataFrame:
    """Cities tracked for more than ``min_days`` days, the most observed first."""
    return summary.filter(F.col("days_tracked") > min_days).orderBy(
        F.col("total_observations").desc_nulls_first(), "city"
    )
