"""The driver's tables seen as weather data.

``events`` gives answers of providers, observations and forecasts; ``nation`` with ``region`` gives
the city dimension.  Nothing is drawn at random: every value follows from a row of the tables.
A request is a fixed run of consecutive event numbers, so its documents stay small at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import NTZ, hour_of, ntz, plus_seconds, seconds_between
from ..functions.scalar import kph_to_ms, lead_hours
from ..operators.nest import nest_current, nest_forecast, to_documents
from ..operators.normalize import accepted, normalize_current, normalize_forecast
from ..schemas import OPEN_END, RAW_EPOCH, raw_key

PROVIDER_OF = {
    "click": "open_meteo",
    "error": "openweathermap",
    "purchase": "weatherapi",
    "signup": "weatherbit",
    "view": "weatherstack",
}
LEADS = [1, 3, 6, 12, 24, 48, 2, 72]
ANSWERS_PER_REQUEST = 5
POINTS_PER_REQUEST = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with a short name for its number, its provider and the hour it falls in."""
    whens = " ".join(f"WHEN '{kind}' THEN '{provider}'" for kind, provider in PROVIDER_OF.items())
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_id AS e",
        f"cast(ts AS {NTZ}) AS ts",
        "user_id",
        "event_type",
        "value",
        "props",
        f"CASE event_type {whens} END AS provider",
        f"{hour_of(f'cast(ts AS {NTZ})')} AS hour",
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities, regions as their countries."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).selectExpr(
        "cast(n_nationkey AS double) AS latitude",
        "n_nationkey + 0.5D AS longitude",
        "n_name AS city",
        "r_name AS country",
    )


def unless(modulus: int, value: str) -> str:
    """NULL for every ``modulus``-th event."""
    return f"CASE WHEN e % {modulus} <> 0 THEN {value} END"


def lead_of(number: str) -> str:
    return f"get(array({', '.join(map(str, LEADS))}), cast({number} % {len(LEADS)} AS int))"


_PLACE = [
    "cast(user_id % 30 AS double) + 0.004D AS latitude",
    "cast(user_id % 30 AS double) + 0.504D AS longitude",
    "concat('C', user_id % 18) AS city",
    "concat('K', (user_id % 18) % 5) AS country",
    "provider",
]
_SKY = [
    "cast(e % 100 AS double) AS cloud_cover_percent",
    "cast(e % 10 AS double) AS visibility_km",
    "cast(e % 12 AS double) AS uv_index",
    "value - (e % 5 * 5) AS feels_like_celsius",
    f"{unless(13, 'cast((e * 5) % 800 AS double) / 2.0D')} AS wind_direction_degrees",
    "concat('W', e % 4) AS weather_condition",
]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staged observations."""
    kph = "cast(e % 37 AS double)"
    return events(spark, sf_dir).selectExpr(
        "e AS id",
        "concat('E', e) AS weather_id",
        *_PLACE,
        "hour AS observation_time",
        "value AS temperature_celsius",
        f"{unless(50, 'cast(e % 101 AS double)')} AS humidity_percent",
        f"{kph_to_ms(kph)} AS wind_speed_ms",
        f"{kph} AS wind_speed_kph",
        "cast(e % 40 + 990 AS double) AS pressure_hpa",
        f"{unless(7, 'cast(e % 23 AS double) / 10.0D')} AS precipitation_mm",
        *_SKY,
        "200 AS status_code",
        "ts AS created_at",
        f"{unless(11, 'ts')} AS updated_at",
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staged forecasts."""
    kph = "cast(e % 41 AS double)"
    made = plus_seconds("hour", f"-({lead_of('e')} * 3600 + ((e * 37) % 41 - 20) * 60)")
    return events(spark, sf_dir).selectExpr("*", f"{made} AS made").selectExpr(
        "e AS id",
        "concat('F', e) AS forecast_id",
        *_PLACE,
        "hour AS forecast_timestamp",
        f"{lead_hours('hour', 'made')} AS hours_ahead",
        "value + ((e * 7) % 13 - 6) AS temperature_celsius",
        f"{unless(60, 'cast((e * 3) % 101 AS double)')} AS humidity_percent",
        f"{kph_to_ms(kph)} AS wind_speed_ms",
        f"{kph} AS wind_speed_kph",
        "cast(e % 40 + 990 AS double) AS pressure_hpa",
        "cast(e % 23 AS double) / 10.0D AS precipitation_mm",
        *_SKY,
        "cast(e % 101 AS double) AS precipitation_probability",
        "200 AS status_code",
        "made AS forecast_created_at",
        "ts AS updated_at",
    )


# Answers of providers


def _at(request: str) -> list[str]:
    return [
        f"cast({request} % 30 AS double) + 0.004D AS latitude",
        f"cast({request} % 30 AS double) + 0.504D AS longitude",
    ]


def _struct(**fields: str) -> str:
    return f"named_struct({', '.join(f'{name!r}, {value}' for name, value in fields.items())})"


def _json(**fields: str) -> str:
    return f"to_json({_struct(**fields)})"


def _epoch(ts: str) -> str:
    return f"cast({seconds_between(ntz(RAW_EPOCH), ts)} AS bigint)"


def _iso(ts: str) -> str:
    return f"replace(cast({ts} AS string), ' ', 'T')"


def _minutes(ts: str) -> str:
    return f"substring(cast({ts} AS string), 1, 16)"


def landing_current(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """One answer per event in the shape of its provider; with ``broken`` some of them are unusable.

    Without, every answer is whole, a provider may answer a request several times, and every 47th answer belongs to none.
    """
    number = "cast(value AS string)"
    if broken:
        number = f"CASE WHEN e % 31 <> 0 THEN CASE WHEN e % 37 = 0 THEN 'n/a' ELSE {number} END END"
    humidity, wind, condition = "e % 101", "e % 37", "concat('W', e % 4)"
    degrees, felt, pressure = "(e * 7) % 400", "value - (e % 5)", "e % 40 + 990"
    open_meteo = _json(
        current_weather=_struct(temperature=number, windspeed=wind, winddirection=degrees, time=_iso("hour"))
    )
    openweather = _json(
        main=_struct(temp=number, humidity=humidity, pressure=pressure, feels_like=felt),
        wind=_struct(speed=wind, deg=degrees),
        weather=f"array({_struct(description=condition)})",
        visibility="e % 10 * 1000",
        clouds=_struct(all="e % 100"),
        dt=_epoch("hour"),
    )
    weatherapi = _json(
        current=_struct(
            temp_c=number,
            humidity=humidity,
            wind_kph=wind,
            condition=_struct(text=condition),
            last_updated=_minutes("hour"),
            pressure_mb=pressure,
            vis_km="e % 10",
            feelslike_c=felt,
            wind_degree=degrees,
            cloudcover="e % 100",
            uv="e % 12",
            precip_mm="e % 23",
        )
    )
    entry = _struct(
        temp=number,
        rh=humidity,
        wind_spd=wind,
        weather=_struct(description=condition),
        ob_time=_minutes("hour"),
        pres=pressure,
        vis="e % 10",
        app_temp=felt,
        wind_dir=degrees,
        clouds="e % 100",
        uv="e % 12",
        precip="e % 23",
    )
    weatherbit = _json(data=f"array({entry})")
    weatherstack = _json(
        location=_struct(localtime=_minutes("hour")),
        current=_struct(
            temperature=number,
            humidity=humidity,
            wind_speed=wind,
            weather_descriptions=f"array({condition}, 'more')",
            pressure=pressure,
            visibility="e % 10",
            feelslike=felt,
            wind_degree=degrees,
            cloudcover="e % 100",
            uv_index="e % 12",
            precip="e % 23",
        ),
    )
    payload = f"""CASE
        WHEN provider = 'open_meteo' THEN {open_meteo}
        WHEN provider = 'openweathermap' THEN {openweather}
        WHEN provider = 'weatherapi' THEN {weatherapi}
        WHEN provider = 'weatherbit' THEN {weatherbit}
        ELSE {weatherstack} END"""
    if broken:
        payload = f"""CASE
            WHEN e % 29 = 0 THEN '{{broken'
            WHEN provider = 'weatherbit' AND e % 19 = 0 THEN '{{"data": []}}'
            WHEN provider = 'weatherstack' AND e % 23 = 0 THEN '{{"error": {{"code": 101, "info": "Invalid access key"}}}}'
            ELSE {payload} END"""
    request = f"floor(e / {ANSWERS_PER_REQUEST})"
    numbered = events(spark, sf_dir).selectExpr("*", f"{request} AS nth")
    # A short row becomes a long answer that is parsed again, and a file of few row groups would be that many tasks.
    numbered = numbered.repartition("nth", F.when(F.col("nth").isNull(), F.col("ts")))
    return numbered.selectExpr(
        "event_id",
        "nth AS request_id" if broken else "CASE WHEN e % 47 <> 0 THEN nth END AS request_id",
        "provider",
        *_at("nth"),
        "ts AS fetched_at",
        f"{payload} AS payload",
    )


def landing_forecast(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """One answer per request and provider with up to ``POINTS_PER_REQUEST`` points; with ``broken`` some are unusable.

    Without, every answer is whole, every seventh request was answered before with the first point alone, and every 23rd answer
    belongs to no request.
    """
    temperature = unless(41, "value") if broken else "value"
    point = _struct(e="e", hour="hour", temp=temperature, hum="e % 101", wind="e % 37", ts="ts")
    numbered = events(spark, sf_dir).selectExpr("*", f"floor(e / {POINTS_PER_REQUEST}) AS request_id")
    grouped = numbered.groupBy("request_id", "provider").agg(F.expr(f"array_sort(collect_list({point})) AS p"))
    grouped = grouped.withColumn("again", F.lit(0))
    if not broken:
        before = F.expr("CASE WHEN request_id % 7 = 0 THEN array(0, 1) ELSE array(0) END")
        grouped = grouped.withColumn("again", F.explode(before)).withColumn("p", F.expr("IF(again = 1, slice(p, 1, 1), p)"))

    def each(make: str) -> str:
        return f"transform(p, x -> {make})"

    hourly = _struct(
        time=each(_iso("x.hour")),
        temperature_2m=each("x.temp"),
        relativehumidity_2m=f"slice({each('x.hum')}, 1, 2)",
        windspeed_10m=each("x.wind"),
    )
    listed = each(
        _struct(dt=_epoch("x.hour"), main=_struct(temp="x.temp", humidity="x.hum"), wind=_struct(speed="x.wind"))
    )
    hours = each(_struct(time=_minutes("x.hour"), temp_c="x.temp", humidity="x.hum", wind_kph="x.wind"))
    # Two days in one answer: the first point, then all others.
    first, rest = _struct(hour=f"slice({hours}, 1, 1)"), _struct(hour=f"slice({hours}, 2, size(p))")
    data = each(
        _struct(
            temp="x.temp",
            rh="x.hum",
            wind_spd="x.wind",
            timestamp_local=f"CASE WHEN x.e % 3 = 0 THEN '' ELSE {_iso('x.hour')} END",
            timestamp_utc=_iso("x.hour"),
        )
    )
    # Keyed by date, one date per point, so that the cut runs across dates; hours are codes.
    code = _struct(
        time="cast(hour(x.hour) * 100 AS string)", temperature="x.temp", humidity="x.hum", wind_speed="x.wind"
    )
    date = f"cast(date_add(date'2024-01-01', cast(x.e % {POINTS_PER_REQUEST} AS int)) AS string)"
    by_date = f"map_from_entries({each(_struct(key=date, value=_struct(hourly=f'array({code})')))})"
    payload = f"""CASE
        WHEN {str(broken).lower()} AND request_id % 17 = 0 THEN '{{broken'
        WHEN provider = 'open_meteo' THEN {_json(hourly=hourly)}
        WHEN provider = 'openweathermap' THEN {_json(list=listed)}
        WHEN provider = 'weatherapi' THEN {_json(forecast=_struct(forecastday=f"array({first}, {rest})"))}
        WHEN provider = 'weatherbit' THEN {_json(data=data)}
        ELSE {_json(forecast=by_date)} END"""
    # Asked for some hours before the first of its events.
    fetched = plus_seconds("get(p, 0).ts", f"-({lead_of('request_id')} + again) * 3600")
    return grouped.selectExpr(
        "request_id" if broken else "CASE WHEN request_id % 23 <> 0 THEN request_id END AS request_id",
        "provider",
        *_at("request_id"),
        "cast(request_id % 3 + 1 AS int) AS hours",
        f"{fetched} AS fetched_at",
        f"{payload} AS payload",
    )


# Documents and raw versions


# Readings of a forecast point beyond those that every provider gives.
EXTRA = {
    "pressure_mb": "q.wind_speed_kph + 990.0D",
    "precip_mm": "q.wind_speed_kph / 8.0D",
    "cloud_cover": "q.humidity",
    "visibility_km": "q.wind_speed_kph / 4.0D",
    "uv_index": "q.wind_speed_kph / 16.0D",
    "feels_like_c": "q.temperature_c - 2.5D",
    "wind_degree": "q.wind_speed_kph * 2.0D",
    "condition": "concat('W', hour(q.time) % 4)",
    "precip_probability": "q.humidity / 2.0D",
}


def with_extra_readings(nested: DataFrame) -> DataFrame:
    """Nested forecasts whose points carry all readings that staging knows."""
    more = ", ".join(f"'{name}', {value}" for name, value in EXTRA.items())
    kept = ", ".join(f"'{f}', q.{f}" for f in ("time", "temperature_c", "wind_speed_kph", "humidity"))
    points = f"transform(x.points, q -> named_struct({kept}, {more}))"
    return nested.withColumn("forecasts", F.expr(f"transform(forecasts, x -> named_struct('provider', x.provider, 'points', {points}))"))


def documents(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Whole answers normalised and nested into stored documents."""
    if kind == "current":
        nested = nest_current(accepted(normalize_current(landing_current(spark, sf_dir, broken=False))))
    else:
        nested = nest_forecast(accepted(normalize_forecast(landing_forecast(spark, sf_dir, broken=False))))
        nested = with_extra_readings(nested)
    status = F.expr("CASE WHEN cast(_id AS bigint) % 19 = 0 THEN 500 ELSE 200 END")
    return to_documents(nested, kind).withColumn("status_code", status)


def raw_versions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Documents as raw versions, every thirteenth of them no longer valid."""
    hours = ["hours"] if kind == "forecast" else []
    return documents(spark, sf_dir, kind).selectExpr(
        "cast(_id AS bigint) AS id",
        f"_id AS {raw_key(kind)}",
        "latitude",
        "longitude",
        *hours,
        "request",
        "response",
        "status_code",
        "created_at",
        "updated_at",
        "created_at AS valid_from_dttm",
        f"CASE WHEN cast(_id AS bigint) % 13 = 0 THEN created_at ELSE {ntz(OPEN_END)} END AS valid_to_dttm",
    )
