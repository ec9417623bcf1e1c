"""Queries for sources, keyed writes, data quality and the jobs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions.clock import day_of, hour_of, ntz
from ..functions.scalar import pg_round
from ..operators import anomalies, quality
from ..operators.dedup import latest_per_key
from ..operators.keyed import delete_insert, merge_upsert, scd2_counts, scd2_history, scd2_upsert
from ..plans import jobs, ods
from ..plans.checks import all_checks
from ..schemas import OPEN_END, PROVIDERS
from ..session import own_folder, written
from ..sources.documents import (
    append_documents,
    high_watermark,
    ods_watermark,
    read_cities,
    read_documents,
    read_since,
    watermark_rows,
)
from ..sources.warehouse import Warehouse
from ..streaming.ingest import stream_ingest
from . import adapters as A
from .duck import CTES, OPEN, ROLLUP, accuracy, actuals, cte, errors, ods_forecasts, ods_observations, r, sql, stg_forecast, summary
from .registry import query

NOW = dt.datetime(2024, 3, 1)


def _new_folder(spark) -> str:
    """A folder of its own for each run, in the folder the cluster shares."""
    return f"{own_folder(spark)}/{uuid.uuid4().hex}"


_DOC = ["_id", "latitude", "longitude", "status_code", "created_at", "updated_at"]

# Sources


@query("src_documents", sql(f"SELECT {', '.join(_DOC)} FROM docs_current", "docs_current"))
def src_documents(spark, sf_dir):
    folder = _new_folder(spark)
    append_documents(A.documents(spark, sf_dir, "current"), folder, "current")
    return read_documents(spark, folder, "current").select(*_DOC)


@query("src_incremental", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def src_incremental(spark, sf_dir):
    since = dt.datetime(2024, 1, 20, 12)
    return read_since(A.table(spark, sf_dir, "events"), "ts", since).select("event_id", "ts")


@query(
    "src_watermark",
    """SELECT 'events' AS source, max(ts) - INTERVAL 1 DAY AS watermark FROM events
    UNION ALL SELECT 'empty', TIMESTAMP '1970-01-01 00:00:00'""",
)
def src_watermark(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    some = watermark_rows(events, "ts").select(F.lit("events").alias("source"), "watermark")
    none = watermark_rows(events.filter(F.lit(False)), "ts").select(F.lit("empty").alias("source"), "watermark")
    return some.unionByName(none)


@query("src_cities", sql("SELECT latitude, longitude, city, country FROM cities", "cities"))
def src_cities(spark, sf_dir):
    folder = _new_folder(spark)
    A.cities(spark, sf_dir).write.option("header", True).csv(folder)
    return read_cities(spark, folder)


@query(
    "src_raw_tables",
    sql(
        f"""SELECT 'current' AS kind, _id AS document_id, latitude, longitude, status_code, created_at, {OPEN} AS valid_to_dttm
        FROM docs_current UNION ALL
        SELECT 'forecast', _id, latitude, longitude, status_code, created_at, {OPEN} FROM docs_forecast""",
        "docs_current",
        "docs_forecast",
    ),
)
def src_raw_tables(spark, sf_dir):
    folder = _new_folder(spark)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    parts = []
    for kind, path in _stored_documents(spark, sf_dir, folder).items():
        warehouse.create_raw(kind)
        jobs.load_kind(warehouse, kind, read_documents(spark, path, kind), NOW)
        parts.append(
            warehouse.read(f"raw.weather_{kind}").select(
                F.lit(kind).alias("kind"),
                F.col("weather_id" if kind == "current" else "forecast_id").alias("document_id"),
                "latitude",
                "longitude",
                "status_code",
                "created_at",
                "valid_to_dttm",
            )
        )
    return parts[0].unionByName(parts[1])


@query("src_ref", sql("SELECT id, city, observation_time, temperature_celsius FROM obs", "obs"))
def src_ref(spark, sf_dir):
    warehouse = Warehouse(spark, _new_folder(spark))
    warehouse.overwrite("stg.weather_current", A.observations(spark, sf_dir), "observation_time")
    return warehouse.read("stg.weather_current").select("id", "city", "observation_time", "temperature_celsius")


# Writes


@query(
    "sink_append_documents",
    sql(
        f"""SELECT {", ".join(_DOC)}, CAST(created_at AS DATE) AS ingest_date FROM docs_forecast""",
        "docs_forecast",
    ),
)
def sink_append_documents(spark, sf_dir):
    folder = _new_folder(spark)
    docs = A.documents(spark, sf_dir, "forecast")
    for half in (0, 1):
        append_documents(docs.filter(F.col("_id").cast("bigint") % 2 == half), folder, "forecast")
    return spark.read.parquet(folder).select(*_DOC, F.col("ingest_date").cast("date").alias("ingest_date"))


def _scd2_inputs(spark, sf_dir):
    """Users as documents: their last event of the first half as target, of the whole month as batch.

    Every seventh user has another key in the target, so the batch brings it anew; the late events of
    every fourth user come under another key, so the user itself does not change after the first half.
    """
    e = A.events(spark, sf_dir).select("user_id", F.col("ts").alias("updated_at"), "value")
    latest = lambda rows: latest_per_key(rows, ["user_id"], ["updated_at DESC NULLS LAST"])
    half = f"updated_at < {ntz(dt.datetime(2024, 1, 16))}"
    early = e.filter(half).withColumn("user_id", F.expr("if(user_id % 7 = 0, -1 - user_id, user_id)"))
    target = latest(early).selectExpr(
        "*", "updated_at AS valid_from_dttm", f"{ntz(OPEN_END)} AS valid_to_dttm"
    )
    late = e.withColumn("user_id", F.expr(f"if(user_id % 4 = 0 AND NOT ({half}), -1000000000 - user_id, user_id)"))
    return target, latest(late)


_SCD2 = """SELECT arg_max(value, ts) AS value, {0} AS user_id, max(ts) AS updated_at FROM ev WHERE {1} GROUP BY {0}"""
cte(
    "scd_target",
    ["ev"],
    _SCD2.format("CASE WHEN user_id % 7 = 0 THEN -1 - user_id ELSE user_id END", "ts < TIMESTAMP '2024-01-16 00:00:00'"),
)
cte(
    "scd_batch",
    ["ev"],
    _SCD2.format(
        "CASE WHEN user_id % 4 = 0 AND NOT (ts < TIMESTAMP '2024-01-16 00:00:00') THEN -1000000000 - user_id ELSE user_id END", "true"
    ),
)
cte(
    "scd_opened",
    ["scd_target", "scd_batch"],
    """SELECT b.*, t.user_id IS NOT NULL AS replaces FROM scd_batch b LEFT JOIN scd_target t USING (user_id)
        WHERE t.user_id IS NULL OR t.updated_at IS DISTINCT FROM b.updated_at""",
)


@query(
    "sink_scd2",
    sql(
        f"""SELECT user_id, updated_at, value, updated_at AS valid_from_dttm,
            CASE WHEN user_id IN (SELECT user_id FROM scd_opened) THEN TIMESTAMP '2024-03-01 00:00:00' ELSE {OPEN} END AS valid_to_dttm
        FROM scd_target UNION ALL
        SELECT user_id, updated_at, value, TIMESTAMP '2024-03-01 00:00:00', {OPEN} FROM scd_opened""",
        "scd_opened",
    ),
)
def sink_scd2(spark, sf_dir):
    target, batch = _scd2_inputs(spark, sf_dir)
    return scd2_upsert(target, batch, "user_id", "updated_at", NOW)


@query(
    "sink_scd2_counts",
    sql(
        """SELECT (SELECT count(*) FROM scd_opened) AS inserted,
            (SELECT count(*) FROM scd_batch) - (SELECT count(*) FROM scd_opened) AS skipped""",
        "scd_opened",
        "scd_batch",
    ),
)
def sink_scd2_counts(spark, sf_dir):
    target, batch = _scd2_inputs(spark, sf_dir)
    return scd2_counts(target, batch, "user_id", "updated_at")


@query(
    "sink_scd2_history",
    f"""SELECT event_id, user_id, ts, ts AS valid_from_dttm,
        coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {OPEN}) AS valid_to_dttm FROM events""",
)
def sink_scd2_history(spark, sf_dir):
    log = A.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return scd2_history(log, "user_id", "ts")


_KEY = ["city", "provider", "observation_time"]
_KEYED = [*_KEY, "id", "temperature_celsius"]


def _target_and_batch(spark, sf_dir):
    """Observations of the first two thirds of the month, and corrected ones of the last two thirds.

    Every third one is never corrected and is in the target whatever its time, so each row is on a side.
    """
    rows = A.observations(spark, sf_dir).select(*_KEYED)
    target = rows.filter(f"observation_time < {ntz(dt.datetime(2024, 1, 21))} OR id % 3 = 0")
    batch = rows.filter(f"observation_time >= {ntz(dt.datetime(2024, 1, 11))}").filter(F.col("id") % 3 != 0)
    return target, batch.withColumn("temperature_celsius", F.col("temperature_celsius") + F.lit(100.0))


cte("kt", ["obs"], "SELECT * FROM obs WHERE observation_time < TIMESTAMP '2024-01-21 00:00:00' OR id % 3 = 0")
cte(
    "kb",
    ["obs"],
    """SELECT * REPLACE (temperature_celsius + 100.0 AS temperature_celsius) FROM obs
        WHERE observation_time >= TIMESTAMP '2024-01-11 00:00:00' AND id % 3 <> 0""",
)


@query(
    "sink_delete_insert",
    sql(
        f"""SELECT {", ".join(_KEYED)} FROM kt t WHERE NOT EXISTS (SELECT 1 FROM kb b WHERE b.city = t.city
            AND b.provider = t.provider AND b.observation_time = t.observation_time)
        UNION ALL SELECT {", ".join(_KEYED)} FROM kb""",
        "kt",
        "kb",
    ),
)
def sink_delete_insert(spark, sf_dir):
    target, batch = _target_and_batch(spark, sf_dir)
    return delete_insert(target, batch, _KEY)


_GROUPED = "SELECT city, provider, observation_time, count(*) AS n, max(temperature_celsius) AS warmest FROM {} GROUP BY ALL"
cte("gt", ["kt"], _GROUPED.format("kt"))
cte("gb", ["kb"], _GROUPED.format("kb"))


@query(
    "sink_merge",
    sql(
        """SELECT city, provider, observation_time, coalesce(b.n, t.n) AS n, coalesce(b.warmest, t.warmest) AS warmest
        FROM gt t FULL JOIN gb b USING (city, provider, observation_time)""",
        "gt",
        "gb",
    ),
)
def sink_merge(spark, sf_dir):
    target, batch = (
        rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("temperature_celsius").alias("warmest"))
        for rows in _target_and_batch(spark, sf_dir)
    )
    # Grouped by the key, so no key occurs twice.
    return merge_upsert(target, batch, _KEY, check=False)


@query(
    "sink_keyed_table",
    sql(
        f"""SELECT {", ".join(_KEYED)} FROM kt t WHERE NOT EXISTS (SELECT 1 FROM kb b WHERE b.city = t.city
            AND b.provider = t.provider AND b.observation_time = t.observation_time)
        UNION ALL SELECT {", ".join(_KEYED)} FROM kb""",
        "kt",
        "kb",
    ),
)
def sink_keyed_table(spark, sf_dir):
    """The same delete and insert on a stored table, where only the batch's days are rewritten."""
    target, batch = _target_and_batch(spark, sf_dir)
    warehouse = Warehouse(spark, _new_folder(spark))
    warehouse.overwrite("ods.weather_observations", target, "observation_time")
    for _ in range(2):  # The second run finds its own rows and replaces them.
        warehouse.upsert("ods.weather_observations", batch, _KEY, "observation_time")
    return warehouse.read("ods.weather_observations")


@query("sink_full_refresh", sql(f"SELECT {', '.join(_KEYED)} FROM kb", "kb"))
def sink_full_refresh(spark, sf_dir):
    target, batch = _target_and_batch(spark, sf_dir)
    warehouse = Warehouse(spark, _new_folder(spark))
    warehouse.overwrite("ods.weather_observations", target, "observation_time")
    warehouse.overwrite("ods.weather_observations", batch, "observation_time")
    return warehouse.read("ods.weather_observations")


@query(
    "inc_watermark_gt",
    """SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-11 00:00:00')""",
)
def inc_watermark_gt(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    loaded = events.filter(f"ts < {ntz(dt.datetime(2024, 1, 11))}")
    since = high_watermark(loaded, "ts", lookback=dt.timedelta(0))
    return read_since(events, "ts", since).select("event_id", "ts")


@query(
    "inc_watermark_ge",
    sql(
        """SELECT id, coalesce(updated_at, created_at, observation_time) AS source_changed_at FROM obs
        WHERE coalesce(updated_at, created_at, observation_time) >= coalesce((SELECT max(coalesce(updated_at, created_at, observation_time))
            FROM obs WHERE observation_time < TIMESTAMP '2024-01-11 00:00:00'), TIMESTAMP '1900-01-01 00:00:00')""",
        "obs",
    ),
)
def inc_watermark_ge(spark, sf_dir):
    rows = A.observations(spark, sf_dir).selectExpr("*", f"{ods.OBSERVATION_CHANGED_AT} AS source_changed_at")
    loaded = rows.filter(f"observation_time < {ntz(dt.datetime(2024, 1, 11))}")
    fresh = read_since(rows, "source_changed_at", ods_watermark(loaded), inclusive=True)
    return fresh.select("id", "source_changed_at")


@query("meta_processed_at", sql("SELECT id, true AS stamped FROM obs", "obs"))
def meta_processed_at(spark, sf_dir):
    stamped = A.observations(spark, sf_dir).selectExpr("id", ods.PROCESSED_NOW)
    return stamped.selectExpr("id", "processed_dttm IS NOT NULL AS stamped")


# Data quality


@query("dq_not_null", sql("SELECT id, observation_time FROM obs WHERE humidity_percent IS NULL", "obs"))
def dq_not_null(spark, sf_dir):
    return quality.failing_not_null(A.observations(spark, sf_dir), "humidity_percent").select("id", "observation_time")


@query(
    "dq_unique",
    sql("SELECT updated_at, count(*) AS n_records FROM (SELECT date_trunc('hour', updated_at) AS updated_at FROM obs) WHERE updated_at IS NOT NULL GROUP BY updated_at HAVING count(*) > 1", "obs"),
)
def dq_unique(spark, sf_dir):
    hourly = A.observations(spark, sf_dir).selectExpr(f"{hour_of('updated_at')} AS updated_at")
    return quality.failing_unique(hourly, "updated_at")


@query(
    "dq_accepted_values",
    sql("SELECT weather_condition, count(*) AS n_records FROM obs WHERE weather_condition NOT IN ('W0', 'W2') GROUP BY weather_condition", "obs"),
)
def dq_accepted_values(spark, sf_dir):
    return quality.failing_accepted_values(A.observations(spark, sf_dir), "weather_condition", ["W0", "W2"])


@query(
    "dq_relationships",
    "SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END FROM customer WHERE c_custkey IS NOT NULL)",
)
def dq_relationships(spark, sf_dir):
    # A customer in debt is known by another key.
    known = A.table(spark, sf_dir, "customer").selectExpr("if(c_acctbal > 0, c_custkey, -c_custkey) AS c_custkey")
    return quality.failing_relationships(A.table(spark, sf_dir, "orders"), "o_custkey", known, "c_custkey")


@query(
    "dq_expression",
    sql("SELECT id, humidity_percent FROM obs WHERE humidity_percent IS NOT NULL AND NOT (humidity_percent BETWEEN 0 AND 90)", "obs"),
)
def dq_expression(spark, sf_dir):
    failing = quality.failing_expression(
        A.observations(spark, sf_dir), "humidity_percent", "between 0 and 90", "humidity_percent is not null"
    )
    return failing.select("id", "humidity_percent")


@query(
    "dq_city_coordinates",
    sql(
        f"""SELECT city, coord_variations, {r("lat_range", 6)} AS lat_range, {r("lon_range", 6)} AS lon_range FROM (
            SELECT city, count(*) AS coord_variations, max(latitude) - min(latitude) AS lat_range,
                max(longitude) - min(longitude) AS lon_range
            FROM (SELECT DISTINCT city, latitude, longitude FROM obs) GROUP BY city)
        WHERE coord_variations > 1 AND (lat_range > 0.1 OR lon_range > 0.1)""",
        "obs",
    ),
)
def dq_city_coordinates(spark, sf_dir):
    failing = quality.failing_city_coordinates(A.observations(spark, sf_dir))
    return failing.withColumns({c: F.expr(pg_round(c, 6)) for c in ("lat_range", "lon_range")})


@query(
    "dq_feels_like",
    sql("SELECT id, feels_like_celsius FROM obs WHERE abs(feels_like_celsius - temperature_celsius) > 15", "obs"),
)
def dq_feels_like(spark, sf_dir):
    return quality.failing_feels_like(A.observations(spark, sf_dir)).select("id", "feels_like_celsius")


def _count(condition: str) -> str:
    return f"(SELECT count(*) FROM ods_obs WHERE {condition})"


@query(
    "dq_severity",
    sql(
        f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error' ELSE 'warn' END AS status FROM (
        SELECT 'not_null' AS kind, 'humidity_percent' AS "column", 'warn' AS severity, {_count("humidity_percent IS NULL")} AS failures
        UNION ALL SELECT 'not_null', 'city', 'error', {_count("city IS NULL")}
        UNION ALL SELECT 'expression', 'temperature_celsius', 'warn', {_count("NOT (temperature_celsius BETWEEN -100 AND 60)")}
        UNION ALL SELECT 'unique', 'observation_id', 'error', 0
        UNION ALL SELECT 'unique', 'weather_condition', 'error',
            (SELECT count(*) FROM (SELECT weather_condition FROM ods_obs GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'accepted_values', 'provider', 'error', 0)""",
        "ods_obs",
    ),
)
def dq_severity(spark, sf_dir):
    model = "ods.weather_observations"
    rows = ods.ods_observations(A.observations(spark, sf_dir))
    checks = [
        quality.Check(model, "humidity_percent", "not_null", "warn"),
        quality.Check(model, "city", "not_null"),
        quality.Check(model, "temperature_celsius", "expression", "warn", expression="between -100 and 60"),
        quality.Check(model, "observation_id", "unique"),
        quality.Check(model, "weather_condition", "unique"),
        quality.Check(model, "provider", "accepted_values", values=tuple(PROVIDERS)),
    ]
    kinds = F.regexp_extract("check", "^(not_null|expression|unique|accepted_values)", 1)
    return quality.run_checks({model: rows}, checks).select(
        kinds.alias("kind"), "column", "severity", "failures", "status"
    )


# Anomalies


def _scored(values: str, by: str = "") -> str:
    partition = f"PARTITION BY {by} " if by else ""
    past = f"({partition}ORDER BY bucket ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
    return f"""SELECT *, coalesce(n_history >= 7 AND value IS NOT NULL AND
            CASE WHEN stddev = 0 THEN abs(value - mean) > 0.000001 ELSE abs(value - mean) > 3.0 * stddev END, false) AS is_anomaly
        FROM (SELECT *, count(value) OVER {past} AS n_history, {r(r(f"avg(value) OVER {past}", 9), 6)} AS mean,
            {r(r(f"stddev_samp(value) OVER {past}", 9), 6)} AS stddev FROM ({values}))"""


_HOURS = "SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS bucket FROM spiky"
# Every hour of the 20th but the first five comes a day late, and the rows that stay carry a high value.
cte(
    "spiky",
    ["ev"],
    """SELECT event_id, ts, date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day, provider,
        CASE WHEN event_id % 90 = 0 THEN NULL WHEN event_id % 80 = 0 THEN 0.0
             WHEN date_trunc('day', ts) = TIMESTAMP '2024-01-20 00:00:00' THEN value + 5000.0 ELSE value END AS value
        FROM (SELECT e AS event_id, provider, value,
                CASE WHEN ts >= TIMESTAMP '2024-01-20 05:00:00' AND ts < TIMESTAMP '2024-01-21 00:00:00'
                     THEN ts + INTERVAL 1 DAY ELSE ts END AS ts FROM ev)""",
)


def _spiky(spark, sf_dir):
    late = f"ts >= {ntz(dt.datetime(2024, 1, 20, 5))} AND ts < {ntz(dt.datetime(2024, 1, 21))}"
    moved = A.events(spark, sf_dir).selectExpr("event_id", "e", "provider", "value", f"if({late}, ts + interval 1 day, ts) AS ts")
    value = f"""CASE WHEN e % 90 = 0 THEN NULL WHEN e % 80 = 0 THEN 0.0D
        WHEN {day_of('ts')} = {ntz(dt.datetime(2024, 1, 20))} THEN value + 5000.0D ELSE value END AS value"""
    return moved.selectExpr("event_id", "ts", f"{hour_of('ts')} AS hour", "provider", value)


_FRESHNESS = f"""SELECT bucket, CAST(date_diff('microsecond', max(newest) OVER (ORDER BY bucket), bucket + INTERVAL 1 HOUR) AS DOUBLE) / 1000000.0 AS value
    FROM ({_HOURS}) LEFT JOIN (SELECT hour AS bucket, max(ts) AS newest FROM spiky GROUP BY hour) USING (bucket)"""
_DAYS = "SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS bucket FROM spiky"
_VOLUME = f"""SELECT bucket, coalesce(n, 0) AS value FROM ({_DAYS})
    LEFT JOIN (SELECT day AS bucket, count(*) AS n FROM spiky GROUP BY day) USING (bucket)"""
_DIMENSION = """SELECT bucket, provider, coalesce(n, 0) AS value FROM (
        SELECT provider, unnest(generate_series(min(day), (SELECT max(day) FROM spiky_source), INTERVAL 1 DAY)) AS bucket
        FROM spiky_source GROUP BY provider)
    LEFT JOIN (SELECT day AS bucket, provider, count(*) AS n FROM spiky_source GROUP BY day, provider) USING (bucket, provider)"""


@query(
    "dq_anom_freshness",
    sql(
        _scored(_FRESHNESS),
        "spiky",
    ),
)
def dq_anom_freshness(spark, sf_dir):
    return anomalies.freshness_anomalies(_spiky(spark, sf_dir), "ts", "hour")


@query(
    "dq_anom_volume",
    sql(
        _scored(_VOLUME),
        "spiky",
    ),
)
def dq_anom_volume(spark, sf_dir):
    return anomalies.volume_anomalies(_spiky(spark, sf_dir), "ts", "day")


# From the 25th on one provider is silent: its events come under the name of another.
cte(
    "spiky_source",
    ["spiky"],
    """SELECT * REPLACE (CASE WHEN provider = 'weatherbit' AND day >= TIMESTAMP '2024-01-25 00:00:00' THEN 'weatherapi'
        ELSE provider END AS provider) FROM spiky""",
)


def _silenced(spark, sf_dir):
    silent = f"provider = 'weatherbit' AND {day_of('ts')} >= {ntz(dt.datetime(2024, 1, 25))}"
    return _spiky(spark, sf_dir).withColumn("provider", F.expr(f"if({silent}, 'weatherapi', provider)"))


@query(
    "dq_anom_dimension",
    sql(
        _scored(_DIMENSION, "provider"),
        "spiky_source",
    ),
)
def dq_anom_dimension(spark, sf_dir):
    return anomalies.dimension_anomalies(_silenced(spark, sf_dir), "ts", "provider")


def _metrics(column: str, metrics: dict[str, str]) -> str:
    """A day without rows has no values: its counts are 0, its ends unknown."""
    return " UNION ALL ".join(
        f"""SELECT bucket, '{column}' AS column_name, '{m}' AS metric, {"coalesce(value, 0.0)" if m.endswith("count") else "value"} AS value
        FROM ({_DAYS}) LEFT JOIN (SELECT day AS bucket, CAST({x} AS DOUBLE) AS value FROM spiky GROUP BY day) USING (bucket)"""
        for m, x in metrics.items()
    )


def _four(c: str) -> dict[str, str]:
    return {
        "zero_count": f"count(*) FILTER (WHERE {c} = 0)",
        "null_count": f"count(*) FILTER (WHERE {c} IS NULL)",
        "min": f"min({c})",
        "max": f"max({c})",
    }


@query("dq_anom_column", sql(_scored(_metrics("value", _four("value")), "column_name, metric"), "spiky"))
def dq_anom_column(spark, sf_dir):
    return anomalies.column_anomalies(_spiky(spark, sf_dir), "ts", ["value"])


@query(
    "dq_anom_all_columns",
    sql(
        _scored(
            " UNION ALL ".join(
                [
                    _metrics("value", _four("value")),
                    _metrics("event_id", _four("event_id")),
                    _metrics("provider", {"null_count": "count(*) FILTER (WHERE provider IS NULL)"}),
                ]
            ),
            "column_name, metric",
        ),
        "spiky",
    ),
)
def dq_anom_all_columns(spark, sf_dir):
    rows = _spiky(spark, sf_dir).drop("hour").withColumn("dbt_batch", F.lit(1))
    return anomalies.all_columns_anomalies(rows, "ts")


@query(
    "dq_anom_event_freshness",
    sql(
        _scored(
            f"""SELECT bucket, value FROM ({_DAYS}) LEFT JOIN (
                SELECT day AS bucket, max(CAST(date_diff('microsecond', hour, ts) AS DOUBLE) / 1000000.0) AS value
                FROM spiky GROUP BY day) USING (bucket)"""
        ),
        "spiky",
    ),
)
def dq_anom_event_freshness(spark, sf_dir):
    return anomalies.event_freshness_anomalies(_spiky(spark, sf_dir), "hour", "ts")


# Jobs


def _stored_documents(spark, sf_dir, folder: str) -> dict[str, str]:
    paths = {kind: f"{folder}/documents/{kind}" for kind in ("current", "forecast")}
    for kind, path in paths.items():
        append_documents(A.documents(spark, sf_dir, kind), path, kind)
    return paths


def _raw_counts(warehouse: Warehouse):
    """Versions per raw table: all, in force, and distinct documents."""
    parts = []
    for kind, key in (("current", "weather_id"), ("forecast", "forecast_id")):
        parts.append(
            warehouse.read(f"raw.weather_{kind}").selectExpr(
                f"'{kind}' AS kind",
                "count(1) AS versions",
                f"count_if(valid_to_dttm = {ntz(OPEN_END)}) AS in_force",
                f"count(DISTINCT {key}) AS documents",
                "max(updated_at) AS newest",
            )
        )
    return parts[0].unionByName(parts[1])


_LOADED = sql(
    """SELECT 'current' AS kind, count(*) AS versions, count(*) AS in_force, count(*) AS documents, max(updated_at) AS newest FROM docs_current
    UNION ALL SELECT 'forecast', count(*), count(*), count(*), max(updated_at) FROM docs_forecast""",
    "docs_current",
    "docs_forecast",
)


@query("pipe_ingest", _LOADED)
def pipe_ingest(spark, sf_dir):
    folder = _new_folder(spark)
    paths = _stored_documents(spark, sf_dir, folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    for _ in range(2):  # The second load reads the last day again and skips all of it.
        jobs.ingest(warehouse, paths, now=NOW)
    return _raw_counts(warehouse)


@query(
    "pipe_ingest_counts",
    sql(
        """SELECT 'current' AS kind, count(*) AS first_inserted, 0 AS first_skipped, 0 AS second_inserted,
            count(*) FILTER (WHERE updated_at > (SELECT max(updated_at) - INTERVAL 1 DAY FROM docs_current)) AS second_skipped FROM docs_current
        UNION ALL SELECT 'forecast', count(*), 0, 0,
            count(*) FILTER (WHERE updated_at > (SELECT max(updated_at) - INTERVAL 1 DAY FROM docs_forecast)) FROM docs_forecast""",
        "docs_current",
        "docs_forecast",
    ),
)
def pipe_ingest_counts(spark, sf_dir):
    """What two loads of the same documents report; the second reads the last day again and skips it."""
    folder = _new_folder(spark)
    paths = _stored_documents(spark, sf_dir, folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    first, second = (jobs.ingest(warehouse, paths, now=NOW) for _ in range(2))
    rows = [(kind, *first[kind], *second[kind]) for kind in first]
    schema = "kind string, first_inserted long, first_skipped long, second_inserted long, second_skipped long"
    return spark.createDataFrame(rows, schema)


@query("pipe_ingest_stream", _LOADED)
def pipe_ingest_stream(spark, sf_dir):
    folder = _new_folder(spark)
    paths = _stored_documents(spark, sf_dir, folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    for kind, path in paths.items():
        stream_ingest(warehouse, kind, path, f"{folder}/checkpoint/{kind}").awaitTermination()
    return _raw_counts(warehouse)


def _built(spark, sf_dir) -> Warehouse:
    folder = _new_folder(spark)
    paths = _stored_documents(spark, sf_dir, folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    jobs.ingest(warehouse, paths, now=NOW)
    jobs.build(warehouse, A.cities(spark, sf_dir))
    return warehouse


# The whole way from answers to the accuracy mart; here every document is in force.
cte(
    "all_stg_current",
    CTES["stg_current"][0],
    CTES["stg_current"][1].replace(" AND d.request_id % 13 <> 0", "").replace("d.request_id AS id", "md5(d._id || '|' || CAST(d.updated_at AS VARCHAR)) AS id"),
)
cte("all_stg_forecast", CTES["stg_forecast"][0], stg_forecast("true").replace("d.request_id AS id", "md5(d._id || '|' || CAST(d.updated_at AS VARCHAR)) AS id"))
cte("all_ods_obs", ["all_stg_current"], ods_observations("all_stg_current"))
cte("all_ods_fc", ["all_stg_forecast"], ods_forecasts("all_stg_forecast"))
cte("all_actuals", ["all_ods_obs"], actuals("all_ods_obs"))
cte("all_errors", ["all_ods_fc", "all_actuals"], errors("all_ods_fc", "all_actuals"))


@query("pipe_transform", sql(accuracy("all_errors"), "all_errors"))
def pipe_transform(spark, sf_dir):
    return _built(spark, sf_dir).read("dm.forecast_accuracy").drop("dbt_updated_at")


# The same with a city for every position, so that every row has a key and is matched when it comes again.
cte(
    "every_city",
    ["cities"],
    """SELECT * FROM cities UNION ALL
        SELECT CAST(range AS DOUBLE), range + 0.5, 'MORE_' || range, 'ELSEWHERE' FROM range(25, 30)""",
)


def _with_every_city(name: str) -> None:
    needs, body = CTES[f"all_{name}"]
    for old in ("stg_current", "stg_forecast", "ods_obs", "ods_fc", "actuals", "errors"):
        body = body.replace(f"all_{old}", f"full_{old}")
    needs = [n.replace("all_", "full_") if n != "all_points" else n for n in needs if n != "cities"]
    cte(f"full_{name}", ["every_city", *needs], body.replace("JOIN cities c", "JOIN every_city c"))


for _name in ("stg_current", "stg_forecast", "ods_obs", "ods_fc", "actuals", "errors"):
    _with_every_city(_name)


def _every_city(spark, sf_dir):
    more = spark.range(25, 30).selectExpr(
        "cast(id AS double) AS latitude", "id + 0.5D AS longitude", "concat('MORE_', id) AS city", "'ELSEWHERE' AS country"
    )
    return A.cities(spark, sf_dir).unionByName(more)


def _built_by_thirds(spark, sf_dir) -> Warehouse:
    """Documents arrive in three parts, the later changed ones later; every layer is built after each.

    From the second part on, a run reads and writes only the days that changed.
    """
    folder = _new_folder(spark)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    cities = _every_city(spark, sf_dir)
    docs = {kind: written(A.documents(spark, sf_dir, kind)) for kind in ("current", "forecast")}
    ends = [dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2100, 1, 1)]
    paths = {kind: f"{folder}/documents/{kind}" for kind in docs}
    for start, end in zip(ends, ends[1:]):
        for kind, path in paths.items():
            arrived = docs[kind].filter(f"updated_at >= {ntz(start)} AND updated_at < {ntz(end)}")
            append_documents(arrived, path, kind)
        jobs.ingest(warehouse, paths, now=NOW)
        jobs.build(warehouse, cities)
    return warehouse


@query("pipe_transform_incremental", sql(accuracy("full_errors"), "full_errors"))
def pipe_transform_incremental(spark, sf_dir):
    """The accuracy mart after three loads, from the partials of days."""
    return _built_by_thirds(spark, sf_dir).read("dm.forecast_accuracy").drop("dbt_updated_at")


@query("dm_city_summary_incremental", sql(summary("full_ods_obs"), "full_ods_obs"))
def dm_city_summary_incremental(spark, sf_dir):
    return _built_by_thirds(spark, sf_dir).read("dm.city_summary").drop("dbt_updated_at")


# The checks of a built warehouse: every declared check counted on its own over the model's rows.
cte("all_accuracy", ["all_errors"], accuracy("all_errors"))
cte("all_rollup", ["all_accuracy"], ROLLUP.replace("FROM accuracy", "FROM all_accuracy"))
cte("all_ranked", ["all_rollup"], CTES["ranked"][1].replace("FROM rollup", "FROM all_rollup"))
cte("all_ranking", ["all_ranked"], CTES["ranking"][1].replace("FROM ranked", "FROM all_ranked"))
cte("all_summary", ["all_ods_obs"], summary("all_ods_obs"))
_VERSION = "md5(_id || '|' || CAST(updated_at AS VARCHAR)) AS id"
_MODEL_OF = {
    "raw.weather_current": ("all_raw_current", "docs_current", f"SELECT *, {_VERSION}, _id AS weather_id, updated_at AS valid_from_dttm, {OPEN} AS valid_to_dttm FROM docs_current"),
    "raw.weather_forecast": ("all_raw_forecast", "docs_forecast", f"SELECT *, {_VERSION}, _id AS forecast_id, updated_at AS valid_from_dttm, {OPEN} AS valid_to_dttm FROM docs_forecast"),
    "stg.weather_current": ("all_stg_current", None, None),
    "stg.weather_forecast": ("all_stg_forecast_named", "all_stg_forecast", "SELECT *, src_forecast_id AS forecast_id FROM all_stg_forecast"),
    "ods.weather_observations": ("all_ods_obs", None, None),
    "ods.weather_forecasts": ("all_ods_fc", None, None),
    "dm.forecast_accuracy": ("all_accuracy", None, None),
    "dm.provider_ranking": ("all_ranking", None, None),
    "dm.city_summary": ("all_summary", None, None),
}
for _source, _needs, _body in _MODEL_OF.values():
    if _body:
        cte(_source, [_needs], _body)
cte(
    "all_seen",
    ["all_ods_obs"],
    """SELECT observation_time AS ts, date_trunc('hour', observation_time) AS hour, date_trunc('day', observation_time) AS day,
        provider, temperature_celsius AS value FROM all_ods_obs WHERE observation_time IS NOT NULL""",
)


def _failures(check: quality.Check) -> str:
    rows, column = _MODEL_OF[check.model][0], check.column
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {rows} WHERE {column} IS NULL"
    if check.kind == "expression":
        return f"SELECT count(*) FROM {rows} WHERE NOT ({column} {check.expression}) AND ({check.where or 'true'})"
    if check.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {column} FROM {rows} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    if check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
        return f"SELECT count(DISTINCT {column}) FROM {rows} WHERE {column} NOT IN ({listed})"
    parent = f"SELECT {check.parent_column} FROM {_MODEL_OF[check.parent][0]} WHERE {check.parent_column} IS NOT NULL"
    return f"SELECT count(*) FROM {rows} WHERE {column} IS NOT NULL AND {column} NOT IN ({parent})"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _all_results() -> str:
    """A row per declared check, and the anomaly checks; marts have one run, so their metrics have no history."""
    rows = [
        f"SELECT {_quoted(c.name)} AS \"check\", '{c.model}' AS model, '{c.column}' AS \"column\", '{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in all_checks()
    ]
    seen, mart = "ods.weather_observations", "dm.forecast_accuracy"
    anomalous = {
        f"freshness_anomalies_{seen}": (seen, _FRESHNESS, ""),
        f"volume_anomalies_{seen}": (seen, _VOLUME, ""),
        f"dimension_anomalies_{seen}": (seen, _DIMENSION, "provider"),
        f"column_anomalies_{seen}": (seen, _metrics("value", _four("value")), "column_name, metric"),
        f"all_columns_anomalies_{mart}": (mart, None, ""),
        f"event_freshness_anomalies_{mart}": (mart, None, ""),
    }
    for name, (model, values, by) in anomalous.items():
        found = "0"
        if values:
            scored = _scored(values.replace("spiky_source", "all_seen").replace("spiky", "all_seen"), by)
            found = f"(SELECT count(*) FILTER (WHERE is_anomaly) FROM ({scored}))"
        rows.append(f"SELECT '{name}', '{model}', NULL, 'warn', {found}")
    status = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error' ELSE 'warn' END AS status"
    return f"SELECT *, {status} FROM ({' UNION ALL '.join(rows)})"


@query("pipe_test", sql(_all_results(), *(m[0] for m in _MODEL_OF.values()), "all_seen"))
def pipe_test(spark, sf_dir):
    results = jobs.check(_built(spark, sf_dir), raise_on_error=False)
    return results.drop("checked_at")
