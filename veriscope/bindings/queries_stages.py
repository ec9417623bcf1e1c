"""Queries for payloads, nesting, history and staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import NTZ, date_and_code, epoch_to_time, iso_time, iso_time_or, ntz, plus_seconds, seconds_between
from ..functions.scalar import at_path, kph_to_ms, lead_hours, m_to_km, ms_to_kph, number_or_null, pg_round
from ..operators import history, nest
from ..operators.matching import enrich_city
from ..operators.normalize import (
    accepted,
    days_for,
    forecast_points,
    normalize_current,
    normalize_forecast,
    outcomes,
    steps_of_three_hours,
)
from ..plans import stg
from ..schemas import RAW_EPOCH, RAW_PATHS
from . import adapters as A
from .duck import HOURS_BETWEEN, lead, r, sql
from .registry import query

SAMPLE = "event_id, request_id, provider, latitude, longitude, fetched_at, temperature_c, wind_speed_kph, humidity, condition, observation_time"
PROPS = "from_json(props, 'k string')"
POINT = "request_id, provider, latitude, longitude, hours, fetched_at, time, temperature_c, wind_speed_kph, humidity"

# Payloads

for _provider, _name in {
    "open_meteo": "open_meteo",
    "openweathermap": "openweather",
    "weatherapi": "weatherapi",
    "weatherbit": "weatherbit",
    "weatherstack": "weatherstack",
}.items():

    def _current(spark, sf_dir, provider=_provider):
        landed = A.landing_current(spark, sf_dir).filter(F.col("provider") == provider)
        return accepted(normalize_current(landed, keep_raw=False))

    def _forecast(spark, sf_dir, provider=_provider):
        landed = A.landing_forecast(spark, sf_dir).filter(F.col("provider") == provider)
        return forecast_points(accepted(normalize_forecast(landed)))

    query(f"norm_cur_{_name}", sql(f"SELECT {SAMPLE} FROM accepted_samples WHERE provider = '{_provider}'", "accepted_samples"))(_current)
    query(f"norm_fc_{_name}", sql(f"SELECT {POINT} FROM accepted_points WHERE provider = '{_provider}'", "accepted_points"))(_forecast)


@query(
    "filter_valid_samples",
    sql(
        """SELECT provider, reject_reason, count(*) AS n FROM (
            SELECT provider, reject_reason FROM answers WHERE reject_reason IS NOT NULL
            UNION ALL SELECT provider, 'accepted' FROM answers WHERE reject_reason IS NULL)
        GROUP BY provider, reject_reason""",
        "answers",
    ),
)
def filter_valid_samples(spark, sf_dir):
    return outcomes(normalize_current(A.landing_current(spark, sf_dir), keep_raw=False))


@query("fn_ms_to_kph", sql("SELECT e AS event_id, CAST(e % 37 AS DOUBLE) * 3.6 AS kph FROM ev", "ev"))
def fn_ms_to_kph(spark, sf_dir):
    return A.events(spark, sf_dir).selectExpr("event_id", f"{ms_to_kph('cast(e % 37 AS double)')} AS kph")


@query("fn_kph_to_ms", sql("SELECT e AS event_id, CAST(e % 37 AS DOUBLE) / 3.6 AS ms FROM ev", "ev"))
def fn_kph_to_ms(spark, sf_dir):
    return A.events(spark, sf_dir).selectExpr("event_id", f"{kph_to_ms('cast(e % 37 AS double)')} AS ms")


@query("fn_m_to_km", sql("SELECT e AS event_id, CAST(e % 9973 AS DOUBLE) / 1000.0 AS km FROM ev", "ev"))
def fn_m_to_km(spark, sf_dir):
    return A.events(spark, sf_dir).selectExpr("event_id", f"{m_to_km('cast(e % 9973 AS double)')} AS km")


@query(
    "fn_epoch_to_ts",
    sql(
        """SELECT e AS event_id, CASE WHEN e % 9 <> 0 THEN
            TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)) END AS at_time,
            CASE WHEN e % 9 <> 0 THEN
            TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)) ELSE ts END AS at_time_or_fetched
        FROM ev""",
        "ev",
    ),
)
def fn_epoch_to_ts(spark, sf_dir):
    seconds = A.unless(9, f"floor({seconds_between(ntz(RAW_EPOCH), 'ts')})")
    at = epoch_to_time(seconds)
    return A.events(spark, sf_dir).selectExpr(
        "event_id", f"{at} AS at_time", f"coalesce({at}, ts) AS at_time_or_fetched"
    )


def _with_iso_texts(spark, sf_dir):
    """ISO text of various forms, some of it unreadable."""
    return A.events(spark, sf_dir).selectExpr("*", "replace(cast(ts AS string), ' ', 'T') AS iso").selectExpr(
        "event_id",
        "ts",
        """CASE e % 6 WHEN 0 THEN substring(iso, 1, 16) WHEN 1 THEN substring(iso, 1, 10)
            WHEN 2 THEN concat(substring(iso, 1, 19), '+03:00') WHEN 3 THEN '' WHEN 4 THEN concat('at ', iso)
            ELSE iso END AS text""",
    )


_ISO = """CASE e % 6 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('day', ts)
    WHEN 2 THEN date_trunc('second', ts) WHEN 5 THEN ts END"""


@query("fn_iso_parse_null", sql(f"SELECT e AS event_id, CAST({_ISO} AS TIMESTAMP) AS at_time FROM ev", "ev"))
def fn_iso_parse_null(spark, sf_dir):
    return _with_iso_texts(spark, sf_dir).selectExpr("event_id", f"{iso_time('text')} AS at_time")


@query("fn_iso_parse_now", sql(f"SELECT e AS event_id, coalesce(CAST({_ISO} AS TIMESTAMP), ts) AS at_time FROM ev", "ev"))
def fn_iso_parse_now(spark, sf_dir):
    return _with_iso_texts(spark, sf_dir).selectExpr("event_id", f"{iso_time_or('text', 'ts')} AS at_time")


@query(
    "fn_hhmm_code",
    sql(
        """SELECT e AS event_id, CASE WHEN e % 10 = 0 THEN ts
            WHEN e % 7 = 0 THEN date_trunc('day', ts)
            WHEN (CASE WHEN code >= 100 THEN code // 100 ELSE code // 60 END) < 24
            THEN date_trunc('day', ts) + to_hours(CAST(CASE WHEN code >= 100 THEN code // 100 ELSE code // 60 END AS INT)) END AS at_time
        FROM (SELECT *, e % 2600 AS code FROM ev)""",
        "ev",
    ),
)
def fn_hhmm_code(spark, sf_dir):
    texts = A.events(spark, sf_dir).selectExpr(
        "event_id",
        "ts",
        "CASE WHEN e % 10 = 0 THEN 'some day' ELSE substring(cast(ts AS string), 1, 10) END AS day",
        "CASE WHEN e % 7 = 0 THEN 'noon' ELSE cast(e % 2600 AS string) END AS code",
    )
    return texts.selectExpr("event_id", f"{date_and_code('day', 'code', 'ts')} AS at_time")


@query(
    "fn_num_or_null",
    sql("SELECT e AS event_id, CASE WHEN e % 15 = 1 THEN CAST(1e30 AS DOUBLE) WHEN e % 3 <> 0 THEN value END AS number FROM ev", "ev"),
)
def fn_num_or_null(spark, sf_dir):
    text = """CASE WHEN e % 6 = 0 THEN 'none' WHEN e % 9 = 0 THEN '12d' WHEN e % 15 = 3 THEN '7F' WHEN e % 15 = 1 THEN '1e30'
        WHEN e % 3 <> 0 THEN cast(value AS string) END"""
    return A.events(spark, sf_dir).selectExpr("event_id", f"{number_or_null(text)} AS number")


@query(
    "fn_json_iso_dates",
    sql(
        """SELECT e AS event_id, '{"outer":{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","list":["'
            || strftime(hour, '%Y-%m-%dT%H:%M:%S.%f') || '"]}}' AS body FROM ev""",
        "ev",
    ),
)
def fn_json_iso_dates(spark, sf_dir):
    nested = F.struct(F.struct(F.col("ts").alias("at"), F.array("hour").alias("list")).alias("outer"))
    return A.events(spark, sf_dir).select("event_id", F.to_json(nested, nest.ISO_JSON).alias("body"))


# Nesting


@query(
    "agg_current_by_request",
    sql(
        f"""SELECT request_id, latitude, longitude, samples_count, providers, sample_temperature_sum,
            {r("average_temperature_c", 6)} AS average_temperature_c, {r("average_humidity", 6)} AS average_humidity
        FROM (SELECT request_id, any_value(latitude) AS latitude, any_value(longitude) AS longitude,
            count(*) AS samples_count, string_agg(provider, ',' ORDER BY provider) AS providers,
            {r("sum(temperature_c)", 6)} AS sample_temperature_sum,
            avg(temperature_c) AS average_temperature_c, avg(humidity) AS average_humidity
            FROM samples GROUP BY request_id)""",
        "samples",
    ),
)
def agg_current_by_request(spark, sf_dir):
    samples = accepted(normalize_current(A.landing_current(spark, sf_dir, broken=False), keep_raw=False))
    total = "aggregate(samples.temperature_c, 0.0D, (total, t) -> total + t)"
    return nest.nest_current(samples).selectExpr(
        "request_id",
        "latitude",
        "longitude",
        "cast(size(samples) AS bigint) AS samples_count",
        # The fixed order of the providers is also their order by name.
        "array_join(samples.provider, ',') AS providers",
        f"{pg_round(total, 6)} AS sample_temperature_sum",
        f"{pg_round('average_temperature_c', 6)} AS average_temperature_c",
        f"{pg_round('average_humidity', 6)} AS average_humidity",
    )


@query(
    "agg_forecast_by_request",
    sql(
        """SELECT d.request_id, d.latitude, d.longitude, d.hours, d.providers_count,
            coalesce(p.points_count, 0) AS points_count, p.first_time
        FROM docs_forecast d LEFT JOIN (SELECT request_id, count(*) AS points_count, min(time) AS first_time
            FROM points GROUP BY request_id) p USING (request_id)""",
        "docs_forecast",
        "points",
    ),
)
def agg_forecast_by_request(spark, sf_dir):
    nested = nest.nest_forecast(accepted(normalize_forecast(A.landing_forecast(spark, sf_dir, broken=False))))
    return nested.selectExpr("*", "flatten(forecasts.points) AS points").selectExpr(
        "request_id",
        "latitude",
        "longitude",
        "hours",
        "cast(size(forecasts) AS bigint) AS providers_count",
        "cast(size(points) AS bigint) AS points_count",
        "array_min(points.time) AS first_time",
    )


@query(
    "forecast_horizon_check",
    sql(
        """SELECT hours, count(*) AS requests, hours BETWEEN 1 AND 168 AS allowed,
            CAST(ceil(least(hours, 120) / 3.0) AS INT) AS three_hour_points,
            greatest(1, CAST(ceil(hours / 24.0) AS INT)) AS days
        FROM (SELECT CASE WHEN e % 5 = 0 THEN 24 ELSE CAST(e % 200 AS INT) END AS hours FROM ev) GROUP BY hours""",
        "ev",
    ),
)
def forecast_horizon_check(spark, sf_dir):
    asked = A.events(spark, sf_dir).selectExpr(f"{A.unless(5, 'cast(e % 200 AS int)')} AS hours")
    counted = nest.with_default_hours(asked).groupBy("hours").agg(F.count(F.lit(1)).alias("requests"))
    return counted.selectExpr(
        "hours",
        "requests",
        f"{nest.hours_allowed('hours')} AS allowed",
        f"{steps_of_three_hours('hours')} AS three_hour_points",
        f"{days_for('hours')} AS days",
    )


# History

_DOC = "_id, latitude, longitude, status_code, created_at"


@query(
    "topk_recent_current",
    sql(f"SELECT {_DOC} FROM docs_current ORDER BY created_at DESC, _id LIMIT 10", "docs_current"),
)
def topk_recent_current(spark, sf_dir):
    return history.most_recent(A.documents(spark, sf_dir, "current")).select(*_DOC.split(", "))


@query(
    "topk_recent_forecast",
    sql(f"SELECT {_DOC}, hours FROM docs_forecast ORDER BY created_at DESC, _id LIMIT 10", "docs_forecast"),
)
def topk_recent_forecast(spark, sf_dir):
    return history.most_recent(A.documents(spark, sf_dir, "forecast")).select(*_DOC.split(", "), "hours")


_HERE = "latitude = CAST(7 AS DOUBLE) + 0.004 AND longitude = CAST(7 AS DOUBLE) + 0.504 AND status_code = 200"


@query(
    "topk_by_location_current",
    sql(f"SELECT {_DOC} FROM docs_current WHERE {_HERE} ORDER BY created_at DESC, _id LIMIT 10", "docs_current"),
)
def topk_by_location_current(spark, sf_dir):
    docs = A.documents(spark, sf_dir, "current")
    return history.most_recent_at(docs, 7.004, 7.504).select(*_DOC.split(", "))


@query(
    "topk_by_location_forecast",
    sql(f"SELECT {_DOC}, hours FROM docs_forecast WHERE {_HERE} ORDER BY created_at DESC, _id LIMIT 10", "docs_forecast"),
)
def topk_by_location_forecast(spark, sf_dir):
    docs = A.documents(spark, sf_dir, "forecast")
    return history.most_recent_at(docs, 7.004, 7.504).select(*_DOC.split(", "), "hours")


@query(
    "count_documents",
    """SELECT 'orders' AS collection, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'total', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)""",
)
def count_documents(spark, sf_dir):
    return history.count_documents(
        orders=A.table(spark, sf_dir, "orders"), lineitem=A.table(spark, sf_dir, "lineitem")
    )


@query(
    "topk_locations_current",
    sql(
        """SELECT latitude, longitude, count(*) AS n FROM docs_current GROUP BY latitude, longitude
        ORDER BY n DESC, latitude, longitude LIMIT 5""",
        "docs_current",
    ),
)
def topk_locations_current(spark, sf_dir):
    return history.busiest(A.documents(spark, sf_dir, "current"), ["latitude", "longitude"])


@query(
    "topk_locations_forecast",
    sql(
        """SELECT latitude, longitude, hours, count(*) AS n FROM docs_forecast GROUP BY latitude, longitude, hours
        ORDER BY n DESC, latitude, longitude, hours LIMIT 5""",
        "docs_forecast",
    ),
)
def topk_locations_forecast(spark, sf_dir):
    return history.busiest(A.documents(spark, sf_dir, "forecast"), ["latitude", "longitude", "hours"])


@query(
    "doc_summary",
    sql(
        f"""SELECT _id, latitude, longitude, created_at, {r("average_temperature_c", 6)} AS average_temperature_c,
            CAST(samples_count AS INT) AS samples_count FROM docs_current ORDER BY created_at DESC, _id LIMIT 3""",
        "docs_current",
    ),
)
def doc_summary(spark, sf_dir):
    summary = history.summarize_current(A.documents(spark, sf_dir, "current"))
    return summary.withColumn("average_temperature_c", F.expr(pg_round("average_temperature_c", 6)))


@query(
    "doc_summary_forecast",
    sql(
        """SELECT _id, latitude, longitude, hours, created_at, CAST(providers_count AS INT) AS providers_count
        FROM docs_forecast ORDER BY created_at DESC, _id LIMIT 3""",
        "docs_forecast",
    ),
)
def doc_summary_forecast(spark, sf_dir):
    return history.summarize_forecast(A.documents(spark, sf_dir, "forecast"))


# Staging


@query(
    "flt_active_scd2",
    sql("SELECT _id, created_at FROM docs_current WHERE request_id % 13 <> 0", "docs_current"),
)
def flt_active_scd2(spark, sf_dir):
    return stg.in_force(A.raw_versions(spark, sf_dir, "current")).select(F.col("weather_id").alias("_id"), "created_at")


@query("flt_status_ok", sql("SELECT _id, created_at FROM docs_current WHERE status_code = 200", "docs_current"))
def flt_status_ok(spark, sf_dir):
    return stg.successful(A.raw_versions(spark, sf_dir, "current")).select(F.col("weather_id").alias("_id"), "created_at")


@query("flt_json_not_null", sql("SELECT e AS event_id FROM ev WHERE json_extract(props, '$.k') IS NOT NULL AND e % 3 <> 0", "ev"))
def flt_json_not_null(spark, sf_dir):
    # Every third text lacks the key.
    text = """CASE WHEN e % 3 = 0 THEN '{"other": 1}' ELSE props END"""
    return A.events(spark, sf_dir).filter(f"get_json_object({text}, '$.k') IS NOT NULL").select("event_id")


@query(
    "json_explode",
    sql(
        "SELECT request_id AS id, provider, temperature_c FROM samples",
        "samples",
    ),
)
def json_explode(spark, sf_dir):
    exploded = stg.explode_samples(A.raw_versions(spark, sf_dir, "current"))
    return exploded.selectExpr(
        "id", "sample.provider AS provider", f"{number_or_null('sample.temperature_c')} AS temperature_c"
    )


@query(
    "json_explode_2level",
    sql("SELECT request_id AS id, provider, temperature_c, time FROM points", "points"),
)
def json_explode_2level(spark, sf_dir):
    exploded = stg.explode_points(A.raw_versions(spark, sf_dir, "forecast"))
    return exploded.selectExpr(
        "id",
        "provider",
        f"{number_or_null('point.temperature_c')} AS temperature_c",
        f"try_cast(point.time AS {NTZ}) AS time",
    )


@query("json_path_text", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path_text(spark, sf_dir):
    return A.table(spark, sf_dir, "events").selectExpr("event_id", f"{at_path(PROPS, 'k')} AS k")


@query("json_path_float", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def json_path_float(spark, sf_dir):
    return A.table(spark, sf_dir, "events").selectExpr("event_id", f"{number_or_null(at_path(PROPS, 'k'))} AS k")


_READINGS = ["pressure_hpa", "visibility_km", "feels_like_celsius", "wind_direction_degrees", "cloud_cover_percent", "uv_index", "precipitation_mm"]


@query(
    "json_provider_dispatch",
    sql(
        f"""SELECT provider, count(*) AS n, {", ".join(f"{r(f'sum({c})', 4)} AS {c}, count({c}) AS known_{c}" for c in _READINGS)}
        FROM stg_current GROUP BY provider""",
        "stg_current",
    ),
)
def json_provider_dispatch(spark, sf_dir):
    versions = stg.successful(stg.in_force(A.raw_versions(spark, sf_dir, "current")))
    readings = stg.explode_samples(versions).selectExpr(
        "sample.provider AS provider", *[f"{stg.provider_reading(c)} AS {c}" for c in RAW_PATHS]
    )
    sums = [x for c in _READINGS for x in (f"{pg_round(f'sum({c})', 4)} AS {c}", f"count({c}) AS known_{c}")]
    return readings.groupBy("provider").agg(*[F.expr(x) for x in ("count(1) AS n", *sums)])


@query(
    "join_coord_left",
    sql(
        """SELECT e AS event_id, c.city, c.country FROM ev
        LEFT JOIN cities c ON round(CAST(CAST(user_id % 30 AS DOUBLE) + 0.004 AS DECIMAL(38, 12)), 2) = round(CAST(c.latitude AS DECIMAL(38, 12)), 2)
        AND round(CAST(CAST(user_id % 30 AS DOUBLE) + 0.504 AS DECIMAL(38, 12)), 2) = round(CAST(c.longitude AS DECIMAL(38, 12)), 2)""",
        "ev",
        "cities",
    ),
)
def join_coord_left(spark, sf_dir):
    rows = A.events(spark, sf_dir).selectExpr(
        "event_id",
        "cast(user_id % 30 AS double) + 0.004D AS latitude",
        "cast(user_id % 30 AS double) + 0.504D AS longitude",
    )
    return enrich_city(rows, A.cities(spark, sf_dir)).select("event_id", "city", "country")


@query(
    "fn_hours_ahead",
    sql(
        f"""SELECT e AS event_id, {HOURS_BETWEEN.format(a="made", b="hour")} AS hours_ahead FROM (
            SELECT *, CASE WHEN e % 10 <> 0 THEN hour - to_seconds({lead("e")} * 3600 - 7200) END AS made FROM ev)""",
        "ev",
    ),
)
def fn_hours_ahead(spark, sf_dir):
    made = A.unless(10, plus_seconds("hour", f"-({A.lead_of('e')} * 3600 - 7200)"))
    return A.events(spark, sf_dir).selectExpr("event_id", f"{lead_hours('hour', made)} AS hours_ahead")


@query(
    "proj_rename",
    sql("SELECT id, created_at AS source_created_at, updated_at AS source_updated_at, updated_at AS forecast_created_at FROM obs", "obs"),
)
def proj_rename(spark, sf_dir):
    return A.observations(spark, sf_dir).selectExpr(
        "id",
        "created_at AS source_created_at",
        "updated_at AS source_updated_at",
        "updated_at AS forecast_created_at",
    )


@query(
    "stg_current",
    sql(
        f"""SELECT * REPLACE ({r("avg_temperature_c", 6)} AS avg_temperature_c, {r("avg_humidity", 6)} AS avg_humidity)
        FROM stg_current""",
        "stg_current",
    ),
)
def stg_current(spark, sf_dir) -> DataFrame:
    staged = stg.stg_current(A.raw_versions(spark, sf_dir, "current"), A.cities(spark, sf_dir))
    return staged.withColumns({c: F.expr(pg_round(c, 6)) for c in ("avg_temperature_c", "avg_humidity")})


@query("stg_forecast", sql("SELECT * RENAME (src_forecast_id AS forecast_id) FROM stg_forecast", "stg_forecast"))
def stg_forecast(spark, sf_dir) -> DataFrame:
    return stg.stg_forecast(A.raw_versions(spark, sf_dir, "forecast"), A.cities(spark, sf_dir))


