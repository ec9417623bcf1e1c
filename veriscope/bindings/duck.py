"""The adapters of ``adapters.py`` and the models over them as SQL for DuckDB."""

from __future__ import annotations

# Fixed values, written out here so that an error in the models' own constants shows.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
COMPASS = [
    (0, 22.5, "N"),
    (22.5, 67.5, "NE"),
    (67.5, 112.5, "E"),
    (112.5, 157.5, "SE"),
    (157.5, 202.5, "S"),
    (202.5, 247.5, "SW"),
    (247.5, 292.5, "W"),
    (292.5, 337.5, "NW"),
    (337.5, 360, "N"),
]
LEAD_HOURS = [1, 3, 6, 12, 24, 48]
# The adapters' choices, likewise.
LEADS = [1, 3, 6, 12, 24, 48, 2, 72]
PROVIDER_OF = {
    "click": "open_meteo",
    "error": "openweathermap",
    "purchase": "weatherapi",
    "signup": "weatherbit",
    "view": "weatherstack",
}


def r(x: str, digits: int) -> str:
    """``pg_round`` in SQL."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{KEY_NULL}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def cardinal(x: str) -> str:
    whens = " ".join(f"WHEN {x} BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in COMPASS)
    return f"CASE {whens} ELSE 'Unknown' END"


def bucket(x: str) -> str:
    whens = " ".join(f"WHEN {x} BETWEEN {h - 0.5} AND {h + 0.5} THEN {h}" for h in LEAD_HOURS)
    return f"CASE {whens} END"


def lead(x: str) -> str:
    return f"list_extract({LEADS}, CAST({x} % {len(LEADS)} AS INT) + 1)"


def c_to_f(x: str) -> str:
    return r(f"{x} * 9.0 / 5.0 + 32", 1)


def unless(modulus: int, value: str) -> str:
    return f"CASE WHEN e % {modulus} <> 0 THEN {value} END"


HOURS_BETWEEN = "greatest(0.0, CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / 1000000.0 / 3600.0)"
OPEN = "TIMESTAMP '5999-01-01 00:00:00'"
_PROVIDER = " ".join(f"WHEN '{t}' THEN '{p}'" for t, p in PROVIDER_OF.items())

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], body: str) -> None:
    CTES[name] = (needs, body)


def sql(body: str, *needs: str) -> str:
    """A statement with the named common tables, and those they need, in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {head}\n{body}" if order else body


cte(
    "ev",
    [],
    f"""SELECT event_id AS e, ts, user_id, value, event_type, props,
        CASE event_type {_PROVIDER} END AS provider, date_trunc('hour', ts) AS hour FROM events""",
)
cte(
    "cities",
    [],
    """SELECT CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_nationkey AS DOUBLE) + 0.5 AS longitude,
        n_name AS city, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
cte(
    "obs",
    ["ev"],
    f"""SELECT e AS id, 'E' || e AS weather_id,
        CAST(user_id % 30 AS DOUBLE) + 0.004 AS latitude, CAST(user_id % 30 AS DOUBLE) + 0.504 AS longitude,
        'C' || (user_id % 18) AS city, 'K' || ((user_id % 18) % 5) AS country, provider,
        hour AS observation_time, value AS temperature_celsius,
        {unless(50, "CAST(e % 101 AS DOUBLE)")} AS humidity_percent,
        CAST(e % 37 AS DOUBLE) / 3.6 AS wind_speed_ms, CAST(e % 37 AS DOUBLE) AS wind_speed_kph,
        CAST(e % 40 + 990 AS DOUBLE) AS pressure_hpa,
        {unless(7, "CAST(e % 23 AS DOUBLE) / 10.0")} AS precipitation_mm,
        CAST(e % 100 AS DOUBLE) AS cloud_cover_percent, CAST(e % 10 AS DOUBLE) AS visibility_km,
        CAST(e % 12 AS DOUBLE) AS uv_index, value - (e % 5 * 5) AS feels_like_celsius,
        {unless(13, "CAST((e * 5) % 800 AS DOUBLE) / 2.0")} AS wind_direction_degrees,
        'W' || (e % 4) AS weather_condition, 200 AS status_code, ts AS created_at,
        {unless(11, "ts")} AS updated_at FROM ev""",
)
cte(
    "fc",
    ["ev"],
    f"""SELECT *, {HOURS_BETWEEN.format(a="forecast_created_at", b="forecast_timestamp")} AS hours_ahead FROM (
        SELECT e AS id, 'F' || e AS src_forecast_id,
        CAST(user_id % 30 AS DOUBLE) + 0.004 AS latitude, CAST(user_id % 30 AS DOUBLE) + 0.504 AS longitude,
        'C' || (user_id % 18) AS city, 'K' || ((user_id % 18) % 5) AS country, provider,
        hour AS forecast_timestamp, value + ((e * 7) % 13 - 6) AS temperature_celsius,
        {unless(60, "CAST((e * 3) % 101 AS DOUBLE)")} AS humidity_percent,
        CAST(e % 41 AS DOUBLE) / 3.6 AS wind_speed_ms, CAST(e % 41 AS DOUBLE) AS wind_speed_kph,
        CAST(e % 40 + 990 AS DOUBLE) AS pressure_hpa, CAST(e % 23 AS DOUBLE) / 10.0 AS precipitation_mm,
        CAST(e % 100 AS DOUBLE) AS cloud_cover_percent, CAST(e % 10 AS DOUBLE) AS visibility_km,
        CAST(e % 12 AS DOUBLE) AS uv_index, value - (e % 5 * 5) AS feels_like_celsius,
        {unless(13, "CAST((e * 5) % 800 AS DOUBLE) / 2.0")} AS wind_direction_degrees,
        'W' || (e % 4) AS weather_condition, CAST(e % 101 AS DOUBLE) AS precipitation_probability,
        hour - to_seconds({lead("e")} * 3600 + ((e * 37) % 41 - 20) * 60) AS forecast_created_at, ts AS updated_at
        FROM ev)""",
)

# Models

_WEATHER = """humidity_percent, wind_speed_ms, wind_speed_kph, pressure_hpa, precipitation_mm,
    cloud_cover_percent, visibility_km, uv_index, wind_direction_degrees"""
ODS_OBS_COLUMNS = f"""observation_id, city, country, latitude, longitude, provider, observation_time,
    temperature_celsius, feels_like_celsius, temperature_fahrenheit, {_WEATHER}, wind_direction_cardinal,
    weather_condition, source_created_at, source_updated_at, source_changed_at"""
ODS_FC_COLUMNS = f"""forecast_id, city, country, latitude, longitude, provider, forecast_timestamp, hours_ahead,
    hours_ahead_interval, temperature_celsius, feels_like_celsius, temperature_fahrenheit, {_WEATHER},
    wind_direction_cardinal, weather_condition, precipitation_probability, forecast_created_at, source_changed_at"""


def ods_observations(source: str) -> str:
    return f"""SELECT *, {key("city", "provider", "observation_time")} AS observation_id,
        {c_to_f("temperature_celsius")} AS temperature_fahrenheit,
        {cardinal("wind_direction_degrees")} AS wind_direction_cardinal,
        created_at AS source_created_at, updated_at AS source_updated_at
        FROM (SELECT *, coalesce(updated_at, created_at, observation_time) AS source_changed_at FROM {source})
        QUALIFY row_number() OVER (PARTITION BY city, provider, observation_time
            ORDER BY source_changed_at DESC NULLS FIRST, updated_at DESC NULLS LAST, created_at DESC NULLS LAST,
                id DESC NULLS LAST, temperature_celsius DESC NULLS LAST) = 1"""


def ods_forecasts(source: str) -> str:
    return f"""SELECT *, {key("city", "provider", "forecast_timestamp", "hours_ahead_interval")} AS forecast_id,
        {c_to_f("temperature_celsius")} AS temperature_fahrenheit,
        {cardinal("wind_direction_degrees")} AS wind_direction_cardinal
        FROM (SELECT *, {bucket("hours_ahead")} AS hours_ahead_interval,
                coalesce(forecast_created_at, forecast_timestamp) AS source_changed_at
              FROM {source} WHERE hours_ahead >= 0 AND hours_ahead <= 48)
        WHERE hours_ahead_interval IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY city, provider, forecast_timestamp, hours_ahead_interval
            ORDER BY source_changed_at DESC NULLS FIRST, forecast_created_at DESC NULLS LAST,
                id DESC NULLS LAST, temperature_celsius DESC NULLS LAST) = 1"""


def actuals(source: str) -> str:
    return f"""SELECT city, observation_time, avg(temperature_celsius) AS actual_temperature,
        avg(humidity_percent) AS actual_humidity, avg(wind_speed_ms) AS actual_wind_speed,
        count(DISTINCT provider) AS providers_count FROM {source} GROUP BY city, observation_time"""


def errors(forecasts: str, actual: str) -> str:
    return f"""SELECT f.city, f.provider, f.forecast_timestamp, f.hours_ahead_interval,
        f.temperature_celsius AS forecast_temperature, a.actual_temperature,
        abs(f.temperature_celsius - a.actual_temperature) AS temperature_error_abs,
        abs(f.humidity_percent - a.actual_humidity) AS humidity_error_abs,
        abs(f.wind_speed_ms - a.actual_wind_speed) AS wind_speed_error_abs,
        power(f.temperature_celsius - a.actual_temperature, 2) AS temperature_squared_error,
        power(f.humidity_percent - a.actual_humidity, 2) AS humidity_squared_error
        FROM {forecasts} f JOIN {actual} a ON f.city = a.city AND f.forecast_timestamp = a.observation_time
        WHERE a.actual_temperature IS NOT NULL"""


def within(x: str, tolerance: float) -> str:
    return r(f"CAST(count(*) FILTER (WHERE {x} <= {tolerance}) AS DOUBLE) / count(*) * 100.0", 1)


def accuracy(source: str) -> str:
    return f"""SELECT provider, hours_ahead_interval, count(*) AS total_forecasts,
        count(DISTINCT city) AS cities_count,
        {r("avg(temperature_error_abs)", 2)} AS temperature_mae,
        {r("sqrt(avg(temperature_squared_error))", 2)} AS temperature_rmse,
        {r("quantile_cont(temperature_error_abs, 0.5)", 2)} AS temperature_median_error,
        {r("max(temperature_error_abs)", 2)} AS temperature_max_error,
        {within("temperature_error_abs", 2)} AS accuracy_within_2deg_pct,
        {within("temperature_error_abs", 5)} AS accuracy_within_5deg_pct,
        {r("avg(humidity_error_abs)", 2)} AS humidity_mae,
        {r("sqrt(avg(humidity_squared_error))", 2)} AS humidity_rmse,
        {within("humidity_error_abs", 10)} AS humidity_accuracy_within_10pct,
        {r("avg(wind_speed_error_abs)", 2)} AS wind_speed_mae
        FROM {source} GROUP BY provider, hours_ahead_interval"""


ROLLUP = """SELECT provider, avg(temperature_mae) AS avg_temperature_mae,
    avg(temperature_rmse) AS avg_temperature_rmse, avg(accuracy_within_2deg_pct) AS avg_accuracy_2deg,
    avg(accuracy_within_5deg_pct) AS avg_accuracy_5deg, avg(humidity_mae) AS avg_humidity_mae,
    avg(wind_speed_mae) AS avg_wind_speed_mae,
    avg(temperature_mae) FILTER (WHERE hours_ahead_interval <= 6) AS short_term_temperature_mae,
    avg(accuracy_within_2deg_pct) FILTER (WHERE hours_ahead_interval <= 6) AS short_term_accuracy_2deg,
    avg(temperature_mae) FILTER (WHERE hours_ahead_interval >= 12) AS long_term_temperature_mae,
    avg(accuracy_within_2deg_pct) FILTER (WHERE hours_ahead_interval >= 12) AS long_term_accuracy_2deg,
    CAST(sum(total_forecasts) AS BIGINT) AS total_forecasts_all_intervals FROM accuracy GROUP BY provider"""


def place(x: str, direction: str = "ASC NULLS LAST") -> str:
    return f"row_number() OVER (ORDER BY round(CAST({x} AS DECIMAL(38, 12)), 9) {direction}, provider)"


cte("ods_obs", ["obs"], ods_observations("obs"))
cte("ods_fc", ["fc"], ods_forecasts("fc"))
cte("actuals", ["ods_obs"], actuals("ods_obs"))
cte("errors", ["ods_fc", "actuals"], errors("ods_fc", "actuals"))
cte("accuracy", ["errors"], accuracy("errors"))
cte("rollup", ["accuracy"], ROLLUP)
cte(
    "ranked",
    ["rollup"],
    f"""SELECT *, (rank_by_temperature_mae + rank_by_accuracy_2deg + rank_h + rank_w) / 4.0 AS overall_rank_score
        FROM (SELECT *, {place("avg_temperature_mae")} AS rank_by_temperature_mae,
            {place("avg_accuracy_2deg", "DESC NULLS FIRST")} AS rank_by_accuracy_2deg,
            {place("avg_humidity_mae")} AS rank_h, {place("avg_wind_speed_mae")} AS rank_w,
            {place("short_term_temperature_mae")} AS rank_short_term,
            {place("long_term_temperature_mae")} AS rank_long_term FROM rollup)""",
)
cte(
    "ranking",
    ["ranked"],
    f"""SELECT provider, row_number() OVER (ORDER BY overall_rank_score, provider) AS overall_rank,
        {r("overall_rank_score", 2)} AS overall_rank_score,
        {r("avg_temperature_mae", 2)} AS avg_temperature_mae, {r("avg_temperature_rmse", 2)} AS avg_temperature_rmse,
        {r("avg_accuracy_2deg", 1)} AS avg_accuracy_2deg_pct, {r("avg_accuracy_5deg", 1)} AS avg_accuracy_5deg_pct,
        {r("avg_humidity_mae", 2)} AS avg_humidity_mae, {r("avg_wind_speed_mae", 2)} AS avg_wind_speed_mae,
        {r("short_term_temperature_mae", 2)} AS short_term_temperature_mae,
        {r("short_term_accuracy_2deg", 1)} AS short_term_accuracy_2deg_pct,
        {r("long_term_temperature_mae", 2)} AS long_term_temperature_mae,
        {r("long_term_accuracy_2deg", 1)} AS long_term_accuracy_2deg_pct,
        rank_by_temperature_mae, rank_by_accuracy_2deg, rank_short_term, rank_long_term,
        total_forecasts_all_intervals FROM ranked""",
)


def summary(source: str) -> str:
    return f"""SELECT *, {r("CAST(total_observations AS DOUBLE) / nullif(days_tracked, 0)", 1)} AS avg_observations_per_day,
        {r("max_temperature - min_temperature", 1)} AS temperature_range FROM (
        SELECT city, country, {r("avg(latitude)", 4)} AS latitude, {r("avg(longitude)", 4)} AS longitude,
        min(observation_time) AS first_observation, max(observation_time) AS last_observation,
        count(DISTINCT date_trunc('day', observation_time)) AS days_tracked, count(*) AS total_observations,
        count(DISTINCT provider) AS providers_count,
        {r("avg(temperature_celsius)", 1)} AS avg_temperature, {r("min(temperature_celsius)", 1)} AS min_temperature,
        {r("max(temperature_celsius)", 1)} AS max_temperature,
        {r("stddev_samp(temperature_celsius)", 1)} AS stddev_temperature,
        {r("avg(humidity_percent)", 1)} AS avg_humidity, {r("min(humidity_percent)", 1)} AS min_humidity,
        {r("max(humidity_percent)", 1)} AS max_humidity, {r("avg(wind_speed_ms)", 1)} AS avg_wind_speed,
        {r("max(wind_speed_ms)", 1)} AS max_wind_speed, {r("avg(precipitation_mm)", 2)} AS avg_precipitation,
        {r("sum(precipitation_mm)", 2)} AS total_precipitation FROM {source} GROUP BY city, country)"""


cte("summary", ["ods_obs"], summary("ods_obs"))

# Answers, documents, raw versions and staging

cte(
    "answers",
    ["ev"],
    """SELECT e, CAST(floor(e / 5) AS BIGINT) AS request_id, provider, ts AS fetched_at, hour, value,
        CASE WHEN e % 29 = 0 THEN 'bad_payload'
             WHEN provider = 'weatherstack' AND e % 23 = 0 THEN 'provider_error'
             WHEN provider = 'weatherbit' AND e % 19 = 0 THEN 'empty_data'
             WHEN e % 31 = 0 THEN 'missing_temperature'
             WHEN e % 37 = 0 THEN 'bad_number' END AS reject_reason FROM ev""",
)
def _samples(source: str) -> str:
    return f"""SELECT e AS event_id, request_id, provider, CAST(request_id % 30 AS DOUBLE) + 0.004 AS latitude,
        CAST(request_id % 30 AS DOUBLE) + 0.504 AS longitude, fetched_at, value AS temperature_c,
        CASE WHEN provider IN ('openweathermap', 'weatherbit') THEN CAST(e % 37 AS DOUBLE) * 3.6
             ELSE CAST(e % 37 AS DOUBLE) END AS wind_speed_kph,
        CASE WHEN provider <> 'open_meteo' THEN CAST(e % 101 AS DOUBLE) END AS humidity,
        CASE WHEN provider <> 'open_meteo' THEN 'W' || (e % 4) END AS condition,
        hour AS observation_time FROM answers WHERE {source}"""


# Answers some of which are broken, and whole answers, of which a request keeps each provider's latest.
cte("accepted_samples", ["answers"], _samples("reject_reason IS NULL"))
cte(
    "samples",
    ["answers"],
    f"""{_samples("e % 47 <> 0")} QUALIFY row_number() OVER (PARTITION BY request_id, provider
        ORDER BY fetched_at DESC, temperature_c DESC, wind_speed_kph DESC) = 1""",
)
cte(
    "docs_current",
    ["samples"],
    """SELECT request_id, CAST(request_id AS VARCHAR) AS _id, any_value(latitude) AS latitude,
        any_value(longitude) AS longitude, CASE WHEN request_id % 19 = 0 THEN 500 ELSE 200 END AS status_code,
        max(fetched_at) AS created_at, max(fetched_at) AS updated_at, count(*) AS samples_count,
        avg(temperature_c) AS average_temperature_c, avg(humidity) AS average_humidity FROM samples GROUP BY request_id""",
)
cte(
    "stg_current",
    ["samples", "docs_current", "cities"],
    f"""SELECT d.request_id AS id, d._id AS weather_id, d.latitude, d.longitude, c.city, c.country, s.provider,
        s.observation_time, s.temperature_c AS temperature_celsius, s.humidity AS humidity_percent,
        s.wind_speed_kph / 3.6 AS wind_speed_ms, s.wind_speed_kph,
        CASE WHEN s.provider <> 'open_meteo' THEN CAST(event_id % 40 + 990 AS DOUBLE) END AS pressure_hpa,
        CASE WHEN s.provider IN ('weatherapi', 'weatherbit', 'weatherstack') THEN CAST(event_id % 23 AS DOUBLE) END
            AS precipitation_mm,
        CASE WHEN s.provider <> 'open_meteo' THEN CAST(event_id % 100 AS DOUBLE) END AS cloud_cover_percent,
        CASE WHEN s.provider <> 'open_meteo' THEN CAST(event_id % 10 AS DOUBLE) END AS visibility_km,
        CASE WHEN s.provider IN ('weatherapi', 'weatherbit', 'weatherstack') THEN CAST(event_id % 12 AS DOUBLE) END
            AS uv_index,
        CASE WHEN s.provider <> 'open_meteo' THEN s.temperature_c - event_id % 5 END AS feels_like_celsius,
        CAST((event_id * 7) % 400 AS DOUBLE) AS wind_direction_degrees, s.condition AS weather_condition,
        d.status_code, d.created_at, d.updated_at, d.created_at AS valid_from_dttm, {OPEN} AS valid_to_dttm,
        d.average_temperature_c AS avg_temperature_c, d.average_humidity AS avg_humidity,
        d.updated_at AS source_updated_at
        FROM docs_current d JOIN samples s USING (request_id)
        LEFT JOIN cities c ON round(CAST(d.latitude AS DECIMAL(38, 12)), 2) = round(CAST(c.latitude AS DECIMAL(38, 12)), 2)
            AND round(CAST(d.longitude AS DECIMAL(38, 12)), 2) = round(CAST(c.longitude AS DECIMAL(38, 12)), 2)
        WHERE d.status_code = 200 AND d.request_id % 13 <> 0""",
)
# One row per forecast point that survives its provider's rules.
cte(
    "all_points",
    ["ev"],
    f"""SELECT *, row_number() OVER (PARTITION BY request_id, provider ORDER BY e) AS pos,
        first_value(ts) OVER (PARTITION BY request_id, provider ORDER BY e) - to_seconds({lead("request_id")} * 3600) AS fetched_at,
        max(CASE WHEN temp IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY request_id, provider) AS gap
        FROM (SELECT e, CAST(floor(e / 20) AS BIGINT) AS request_id, provider, ts, hour, value,
            {unless(41, "value")} AS temp FROM ev)""",
)


def _points(temp: str, order: str, valid: str) -> str:
    return f"""SELECT e, request_id, provider, CAST(request_id % 30 AS DOUBLE) + 0.004 AS latitude,
        CAST(request_id % 30 AS DOUBLE) + 0.504 AS longitude, hours, fetched_at,
        CASE WHEN provider = 'weatherstack'
             THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(e % 20 AS INT)) + to_hours(CAST(date_part('hour', hour) AS INT))
             ELSE hour END AS time,
        {temp} AS temperature_c,
        CASE WHEN provider IN ('openweathermap', 'weatherbit') THEN CAST(e % 37 AS DOUBLE) * 3.6
             ELSE CAST(e % 37 AS DOUBLE) END AS wind_speed_kph,
        CASE WHEN provider = 'open_meteo' AND pos > 2 THEN NULL ELSE CAST(e % 101 AS DOUBLE) END AS humidity
        FROM (SELECT *, CAST(request_id % 3 + 1 AS INT) AS hours,
                row_number() OVER (PARTITION BY request_id, provider ORDER BY {order}e) AS kept FROM all_points)
        WHERE {valid} AND NOT (provider IN ('weatherapi', 'weatherstack') AND kept > hours)"""


_UNBROKEN = "request_id % 17 <> 0 AND temp IS NOT NULL AND NOT (provider IN ('open_meteo', 'openweathermap') AND gap = 1)"
cte("accepted_points", ["all_points"], _points("temp", "temp IS NULL, ", _UNBROKEN))
# Whole answers; of a request that was answered before, only the latest answer counts.
cte("points", ["all_points"], _points("value", "", "request_id % 23 <> 0"))
cte(
    "docs_forecast",
    ["all_points"],
    """SELECT request_id, CAST(request_id AS VARCHAR) AS _id, CAST(request_id % 30 AS DOUBLE) + 0.004 AS latitude,
        CAST(request_id % 30 AS DOUBLE) + 0.504 AS longitude, CAST(request_id % 3 + 1 AS INT) AS hours,
        CASE WHEN request_id % 19 = 0 THEN 500 ELSE 200 END AS status_code,
        max(fetched_at) AS created_at, max(fetched_at) AS updated_at, count(DISTINCT provider) AS providers_count
        FROM all_points WHERE request_id % 23 <> 0 GROUP BY request_id""",
)


def stg_forecast(valid: str) -> str:
    return f"""SELECT d.request_id AS id, d._id AS src_forecast_id, d.latitude, d.longitude, c.city, c.country, p.provider,
        p.time AS forecast_timestamp,
        {HOURS_BETWEEN.format(a="d.created_at", b="p.time")} AS hours_ahead,
        p.temperature_c AS temperature_celsius, p.humidity AS humidity_percent,
        p.wind_speed_kph / 3.6 AS wind_speed_ms, p.wind_speed_kph,
        p.wind_speed_kph + 990.0 AS pressure_hpa, p.wind_speed_kph / 8.0 AS precipitation_mm,
        p.humidity AS cloud_cover_percent, p.wind_speed_kph / 4.0 AS visibility_km,
        p.wind_speed_kph / 16.0 AS uv_index, p.temperature_c - 2.5 AS feels_like_celsius,
        p.wind_speed_kph * 2.0 AS wind_direction_degrees, 'W' || (date_part('hour', p.time) % 4) AS weather_condition,
        p.humidity / 2.0 AS precipitation_probability,
        d.status_code, d.created_at AS forecast_created_at, d.updated_at, d.created_at AS valid_from_dttm,
        {OPEN} AS valid_to_dttm
        FROM docs_forecast d JOIN points p USING (request_id)
        LEFT JOIN cities c ON round(CAST(d.latitude AS DECIMAL(38, 12)), 2) = round(CAST(c.latitude AS DECIMAL(38, 12)), 2)
            AND round(CAST(d.longitude AS DECIMAL(38, 12)), 2) = round(CAST(c.longitude AS DECIMAL(38, 12)), 2)
        WHERE d.status_code = 200 AND {valid}"""


cte("stg_forecast", ["docs_forecast", "points", "cities"], stg_forecast("d.request_id % 13 <> 0"))
