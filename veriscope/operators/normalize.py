"""Provider payloads to one sample model and one forecast model.

Input is a landing table (``schemas.LANDING_CURRENT`` / ``LANDING_FORECAST``), one row per answer
of one provider.  A payload is parsed once, with a schema that covers what is read of all
providers; which field feeds which column is chosen per row by provider.  Nothing is exploded or
shuffled: points stay an array of their row.

Every function returns all rows with a ``reject_reason``; :func:`accepted` and :func:`rejected`
split them, so a bad answer of one provider never stops the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import date_and_code, epoch_to_time, iso_time, iso_time_or
from ..functions.scalar import ms_to_kph, number_or_null
from ..schemas import DEFAULT_HOURS, MAX_HOURS, MIN_HOURS, PROVIDERS

CURRENT_PAYLOAD = """
    current_weather struct<temperature string, windspeed string, time string>,
    main struct<temp string, humidity string>,
    wind struct<speed string>,
    weather array<struct<description string>>,
    dt double,
    current struct<
        temp_c string, wind_kph string, condition struct<text string>, last_updated string,
        temperature string, humidity string, wind_speed string, weather_descriptions array<string>>,
    location struct<localtime string>,
    data array<struct<
        temp string, rh string, wind_spd string, weather struct<description string>, ob_time string>>
"""

FORECAST_PAYLOAD = """
    hourly struct<
        time array<string>, temperature_2m array<string>,
        relativehumidity_2m array<string>, windspeed_10m array<string>>,
    list array<struct<dt double, main struct<temp string, humidity string>, wind struct<speed string>>>,
    forecast struct<forecastday array<struct<hour array<struct<
        time string, temp_c string, humidity string, wind_kph string>>>>>,
    data array<struct<
        temp string, rh string, wind_spd string, timestamp_local string, timestamp_utc string>>
"""
POINTS = """array<struct<
    time: timestamp_ntz, temperature_c: double, wind_speed_kph: double, humidity: double,
    bad_number: boolean, no_temperature: boolean>>"""
IN_METRES_PER_SECOND = "provider IN ('openweathermap', 'weatherbit')"
# The one provider that keys its days by date instead of listing them.
DATED_PAYLOAD = """
    forecast map<string, struct<hourly array<struct<
        time string, temperature string, humidity string, wind_speed string>>>>
"""


def _by_provider(cases: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{provider}' THEN {value}" for provider, value in cases.items())
    return f"CASE provider {whens} END"


def _once(value: str, name: str) -> str:
    """A costly value that is computed once per row.

    Spark moves filters on a plain column below the projection that makes it, and would compute
    (here: parse) it again for the filter.  It does not move them below a generator.
    """
    return f"explode_outer(array({value})) AS {name}"


def _from_json(schema: str) -> str:
    return f"from_json(payload, '{' '.join(schema.split())}')"


IS_OBJECT = "json_object_keys(payload) IS NOT NULL"
NAMES_ERROR = "provider = 'weatherstack' AND array_contains(json_object_keys(payload), 'error')"
UNKNOWN = f"provider IS NULL OR provider NOT IN ({', '.join(repr(p) for p in PROVIDERS)})"


def _unreadable(*texts: str) -> str:
    return " OR ".join(f"({t} IS NOT NULL AND {number_or_null(t)} IS NULL)" for t in texts)


def normalize_current(landing: DataFrame, keep_raw: bool = True) -> DataFrame:
    """One normalised sample per landed answer, with the reason if the answer is unusable."""
    kept = [c for c in landing.columns if c != "payload"]
    temperature = {
        "open_meteo": "p.current_weather.temperature",
        "openweathermap": "p.main.temp",
        "weatherapi": "p.current.temp_c",
        "weatherbit": "get(p.data, 0).temp",
        "weatherstack": "p.current.temperature",
    }
    humidity = {
        "openweathermap": "p.main.humidity",
        "weatherapi": "p.current.humidity",
        "weatherbit": "get(p.data, 0).rh",
        "weatherstack": "p.current.humidity",
    }
    wind = {
        "open_meteo": "p.current_weather.windspeed",
        "openweathermap": "p.wind.speed",
        "weatherapi": "p.current.wind_kph",
        "weatherbit": "get(p.data, 0).wind_spd",
        "weatherstack": "p.current.wind_speed",
    }
    condition = {
        "openweathermap": "get(p.weather, 0).description",
        "weatherapi": "p.current.condition.text",
        "weatherbit": "get(p.data, 0).weather.description",
        "weatherstack": "get(p.current.weather_descriptions, 0)",
    }
    time = {
        "open_meteo": iso_time("p.current_weather.time"),
        "openweathermap": epoch_to_time("p.dt"),
        "weatherapi": iso_time("p.current.last_updated"),
        "weatherbit": iso_time("get(p.data, 0).ob_time"),
        "weatherstack": iso_time("p.location.localtime"),
    }
    texts = landing.selectExpr("*", _once(_from_json(CURRENT_PAYLOAD), "p")).selectExpr(
        *kept,
        "payload",
        "p",
        f"{_by_provider(temperature)} AS temperature_text",
        f"{_by_provider(humidity)} AS humidity_text",
        f"{_by_provider(wind)} AS wind_text",
        f"{_by_provider(condition)} AS condition",
        f"{_by_provider(time)} AS observation_time",
    )
    reason = f"""CASE
        WHEN {UNKNOWN} THEN 'unknown_provider'
        WHEN NOT ({IS_OBJECT}) THEN 'bad_payload'
        WHEN {NAMES_ERROR} THEN 'provider_error'
        WHEN provider = 'weatherbit' AND coalesce(size(p.data), 0) < 1 THEN 'empty_data'
        WHEN {_unreadable("temperature_text", "humidity_text", "wind_text")} THEN 'bad_number'
        WHEN temperature_text IS NULL THEN 'missing_temperature'
        WHEN request_id IS NULL THEN 'no_request' END"""
    speed = number_or_null("wind_text")
    return texts.selectExpr(
        *kept,
        f"{number_or_null('temperature_text')} AS temperature_c",
        f"CASE WHEN {IN_METRES_PER_SECOND} THEN {ms_to_kph(speed)} ELSE {speed} END AS wind_speed_kph",
        f"{number_or_null('humidity_text')} AS humidity",
        "condition",
        "observation_time",
        *(["try_parse_json(payload) AS raw"] if keep_raw else []),
        f"{reason} AS reject_reason",
    )


def _point(time: str, temp: str, humidity: str, wind: str, in_ms: bool = False) -> str:
    kph = number_or_null(wind)
    return f"""named_struct(
        'time', {time},
        'temperature_c', {number_or_null(temp)},
        'wind_speed_kph', {ms_to_kph(kph) if in_ms else kph},
        'humidity', {number_or_null(humidity)},
        'bad_number', {_unreadable(temp, humidity, wind)},
        'no_temperature', {temp} IS NULL)"""


def _nested(entries: str, inner: str, each: str = "") -> str:
    """The inner arrays of an array, a missing one counting as empty, as one array."""
    known = f"filter({entries}, x -> {inner} IS NOT NULL)"
    return f"flatten(transform({known}, x -> {each or inner}))"


def normalize_forecast(landing: DataFrame) -> DataFrame:
    """One row per landed answer with its ``points`` array, and the reason if unusable.

    Three providers lose single points without a temperature; the other two lose the whole answer.
    ``hours`` cuts the list of the two providers that answer in whole days.
    """
    hours = f"coalesce(hours, {DEFAULT_HOURS})"
    now = "fetched_at"
    parsed = landing.selectExpr(
        "*",
        _once(
            f"""named_struct(
            'listed', CASE WHEN provider <> 'weatherstack' THEN {_from_json(FORECAST_PAYLOAD)} END,
            'dated', CASE WHEN provider = 'weatherstack' THEN {_from_json(DATED_PAYLOAD)} END)""",
            "p",
        ),
    )
    hourly = "p.listed.hourly"
    # As many points as there are both times and temperatures; the other lists may be shorter.
    timed = f"slice({hourly}.time, 1, least(size({hourly}.time), size({hourly}.temperature_2m)))"
    nth = lambda name: f"get({hourly}.{name}, n)"
    local_or_utc = "coalesce(nullif(i.timestamp_local, ''), i.timestamp_utc)"
    of_days = _nested("p.listed.forecast.forecastday", "x.hour")
    of_dates = _nested(
        "map_entries(p.dated.forecast)",
        "x.value.hourly",
        "transform(x.value.hourly, h -> named_struct('date', x.key, 'h', h))",
    )
    with_temperature = "q -> NOT q.no_temperature"
    points = {
        "open_meteo": f"""transform({timed}, (t, n) -> {_point(
            iso_time_or('t', now), nth('temperature_2m'), nth('relativehumidity_2m'), nth('windspeed_10m')
        )})""",
        "openweathermap": f"""transform(p.listed.list, i -> {_point(
            f"coalesce({epoch_to_time('i.dt')}, {now})", 'i.main.temp', 'i.main.humidity', 'i.wind.speed', in_ms=True
        )})""",
        "weatherapi": f"""filter(transform({of_days}, h -> {_point(
            iso_time_or('h.time', now), 'h.temp_c', 'h.humidity', 'h.wind_kph'
        )}), {with_temperature})""",
        "weatherbit": f"""filter(transform(p.listed.data, i -> {_point(
            iso_time_or(local_or_utc, now), 'i.temp', 'i.rh', 'i.wind_spd', in_ms=True
        )}), {with_temperature})""",
        "weatherstack": f"""filter(transform({of_dates}, y -> {_point(
            date_and_code('y.date', 'y.h.time', now), 'y.h.temperature', 'y.h.humidity', 'y.h.wind_speed'
        )}), {with_temperature})""",
    }
    listed = parsed.selectExpr(
        *landing.columns, _once(f"coalesce({_by_provider(points)}, cast(array() AS {POINTS}))", "listed")
    )
    reason = f"""CASE
        WHEN {UNKNOWN} THEN 'unknown_provider'
        WHEN NOT ({hours} BETWEEN {MIN_HOURS} AND {MAX_HOURS}) THEN 'hours_out_of_range'
        WHEN NOT ({IS_OBJECT}) THEN 'bad_payload'
        WHEN {NAMES_ERROR} THEN 'provider_error'
        WHEN exists(listed, q -> q.bad_number) THEN 'bad_number'
        WHEN exists(listed, q -> q.no_temperature) THEN 'missing_temperature'
        WHEN exists(listed, q -> q.time IS NULL) THEN 'bad_time'
        WHEN request_id IS NULL THEN 'no_request' END"""
    cut = f"CASE WHEN provider IN ('weatherapi', 'weatherstack') THEN slice(listed, 1, {hours}) ELSE listed END"
    fields = ", ".join(f"'{f}', q.{f}" for f in ("time", "temperature_c", "wind_speed_kph", "humidity"))
    return listed.selectExpr(
        *[c for c in landing.columns if c != "payload"],
        f"transform({cut}, q -> named_struct({fields})) AS points",
        f"{reason} AS reject_reason",
    )


def forecast_points(forecasts: DataFrame) -> DataFrame:
    """One row per forecast point of normalised forecasts."""
    keep = [c for c in forecasts.columns if c not in ("points", "reject_reason")]
    return forecasts.select(*keep, F.inline("points"))


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNotNull())


def outcomes(normalized: DataFrame) -> DataFrame:
    """How many answers of each provider were accepted, or rejected for which reason, in one pass."""
    outcome = normalized.selectExpr("provider", "coalesce(reject_reason, 'accepted') AS reject_reason")
    return outcome.groupBy("provider", "reject_reason").agg(F.expr("count(1) AS n"))


def steps_of_three_hours(hours: str) -> str:
    """Number of three-hour points to ask for a horizon, which ends after five days there."""
    return f"cast(ceil(least({hours}, {5 * 24}) / 3) AS int)"


def days_for(hours: str) -> str:
    """Number of whole days, at least one, to ask for a horizon."""
    return f"greatest(1, cast(ceil({hours} / 24) AS int))"
