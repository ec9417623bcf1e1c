"""Golden rows for all ten payload shapes."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from veriscope.operators.nest import nest_current, nest_forecast, to_documents
from veriscope.operators.normalize import (
    accepted,
    forecast_points,
    normalize_current,
    normalize_forecast,
    rejected,
)
from veriscope.plans.stg import explode_samples
from veriscope.schemas import LANDING_CURRENT, LANDING_FORECAST

FETCHED = dt.datetime(2025, 12, 1, 9, 30)


def current(spark, *answers):
    rows = [("r", p, 52.52, 13.405, FETCHED, b if isinstance(b, str) else json.dumps(b)) for p, b in answers]
    return normalize_current(spark.createDataFrame(rows, LANDING_CURRENT))


def forecast(spark, provider, body, hours=24):
    text = body if isinstance(body, str) else json.dumps(body)
    row = ("r", provider, 52.52, 13.405, hours, FETCHED, text)
    return normalize_forecast(spark.createDataFrame([row], LANDING_FORECAST))


def points(df):
    return [tuple(p) for p in df.first()["points"]]


GOLDEN = [
    (
        "open_meteo",
        {"current_weather": {"temperature": -3.25, "windspeed": 27.5, "time": "2024-02-29T23:00:00"}},
        (-3.25, 27.5, None, None, dt.datetime(2024, 2, 29, 23)),
    ),
    (
        "openweathermap",
        {
            "main": {"temp": 31.75, "humidity": 13},
            "wind": {"speed": 5.5},
            "weather": [{"description": "dust"}, {"description": "haze"}],
            "dt": 1710000000,
        },
        (31.75, 19.8, 13.0, "dust", dt.datetime(2024, 3, 9, 16)),
    ),
    (
        "weatherapi",
        {
            "location": {"name": "Quito"},
            "current": {
                "temp_c": 0.5,
                "humidity": 97,
                "wind_kph": 41.5,
                "condition": {"text": "Sleet"},
                "last_updated": "2024-07-04 03:05",
            },
        },
        (0.5, 41.5, 97.0, "Sleet", dt.datetime(2024, 7, 4, 3, 5)),
    ),
    (
        "weatherbit",
        {
            "data": [
                {
                    "temp": 44.25,
                    "rh": 5,
                    "wind_spd": 12.5,
                    "weather": {"description": "Hot wind"},
                    "ob_time": "2024-08-15 06:50",
                }
            ],
            "count": 1,
        },
        (44.25, 45.0, 5.0, "Hot wind", dt.datetime(2024, 8, 15, 6, 50)),
    ),
    (
        "weatherstack",
        {
            "location": {"name": "Hobart", "localtime": "2024-11-11 11:11"},
            "current": {
                "temperature": -12,
                "humidity": 66,
                "wind_speed": 3,
                "weather_descriptions": ["Ice fog"],
            },
        },
        (-12.0, 3.0, 66.0, "Ice fog", dt.datetime(2024, 11, 11, 11, 11)),
    ),
]


@pytest.mark.parametrize("provider, body, expected", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_current_payload(spark, provider, body, expected):
    row = accepted(current(spark, (provider, body))).first()
    found = (row.temperature_c, row.wind_speed_kph, row.humidity, row.condition, row.observation_time)
    assert found[0] == expected[0] and found[1] == pytest.approx(expected[1]) and found[2:] == expected[2:]


@pytest.mark.parametrize(
    "provider, body, reason",
    [
        ("weatherbit", {"data": []}, "empty_data"),
        ("weatherbit", {}, "empty_data"),
        ("weatherstack", {"error": {"code": 777, "info": "no such plan"}}, "provider_error"),
        ("weatherstack", {"error": None, "current": {"temperature": 1}}, "provider_error"),
        ("open_meteo", {"current_weather": {"windspeed": 1}}, "missing_temperature"),
        ("openweathermap", {"main": {"temp": 1, "humidity": "damp"}}, "bad_number"),
        ("weatherapi", "{broken", "bad_payload"),
        ("weatherapi", "[]", "bad_payload"),
        ("elsewhere", {"main": {"temp": 1}}, "unknown_provider"),
    ],
)
def test_current_rejects(spark, provider, body, reason):
    normalized = current(spark, (provider, body))
    assert accepted(normalized).count() == 0
    assert rejected(normalized).first()["reject_reason"] == reason


def test_numbers_as_text_and_a_stamp_as_text(spark):
    row = current(spark, ("openweathermap", {"main": {"temp": "4.5"}, "dt": "1609459200"})).first()
    assert row.temperature_c == 4.5
    assert row.observation_time is None and row.reject_reason is None


def test_open_meteo_forecast_zips_to_the_shorter_of_time_and_temperature(spark):
    body = {
        "hourly": {
            "time": ["2025-12-01T00:00", "2025-12-01T01:00", "2025-12-01T02:00"],
            "temperature_2m": [1.0, 2.0],
            "relativehumidity_2m": [50],
            "windspeed_10m": [],
        }
    }
    assert points(forecast(spark, "open_meteo", body)) == [
        (dt.datetime(2025, 12, 1, 0), 1.0, None, 50.0),
        (dt.datetime(2025, 12, 1, 1), 2.0, None, None),
    ]


def test_open_meteo_forecast_without_a_temperature_is_lost(spark):
    body = {"hourly": {"time": ["2025-12-01T00:00", "2025-12-01T01:00"], "temperature_2m": [1.0, None]}}
    assert forecast(spark, "open_meteo", body).first()["reject_reason"] == "missing_temperature"


def test_openweather_forecast(spark):
    body = {
        "list": [
            {"dt": 1609459200, "main": {"temp": 1.0, "humidity": 80}, "wind": {"speed": 10}},
            {"main": {"temp": 2.0}},
        ]
    }
    assert points(forecast(spark, "openweathermap", body)) == [
        (dt.datetime(2021, 1, 1), 1.0, 36.0, 80.0),
        (FETCHED, 2.0, None, None),
    ]


def test_weatherapi_forecast_drops_points_before_it_cuts(spark):
    hour = lambda day, h, t: {"time": f"2025-12-0{day} {h:02d}:00", "temp_c": t, "wind_kph": 5}
    days = [{"hour": [hour(d, h, None if h == 0 else h) for h in range(24)]} for d in (1, 2)]
    found = points(forecast(spark, "weatherapi", {"forecast": {"forecastday": [*days, {}]}}, hours=24))
    assert len(found) == 24
    assert found[0][0] == dt.datetime(2025, 12, 1, 1) and found[-1][0] == dt.datetime(2025, 12, 2, 1)


def test_weatherapi_forecast_with_a_bad_number_behind_the_cut_is_lost(spark):
    hours = [{"time": "2025-12-01 00:00", "temp_c": 1}, {"time": "2025-12-01 01:00", "temp_c": "warm"}]
    body = {"forecast": {"forecastday": [{"hour": hours}]}}
    assert forecast(spark, "weatherapi", body, hours=1).first()["reject_reason"] == "bad_number"


def test_weatherbit_forecast_takes_utc_when_local_is_missing(spark):
    body = {
        "data": [
            {"temp": 1, "rh": 2, "wind_spd": 1, "timestamp_local": "", "timestamp_utc": "2025-12-01T01:00:00"},
            {"temp": None, "timestamp_local": "2025-12-01T02:00:00"},
            {"temp": 3, "timestamp_local": "2025-12-01T03:00:00", "timestamp_utc": "2025-12-01T00:00:00"},
            {"temp": 4, "timestamp_local": "soon"},
        ]
    }
    # One provider is not cut to the hours asked for.
    found = points(forecast(spark, "weatherbit", body, hours=1))
    assert found == [
        (dt.datetime(2025, 12, 1, 1), 1.0, 3.6, 2.0),
        (dt.datetime(2025, 12, 1, 3), 3.0, None, None),
        (FETCHED, 4.0, None, None),
    ]


def test_weatherstack_forecast_codes_and_cut_across_dates(spark):
    entry = lambda code, t=1: {"time": code, "temperature": t, "humidity": 10, "wind_speed": 2}
    body = {
        "forecast": {
            "2025-12-02": {"hourly": [entry("0"), entry("300"), entry("2300"), entry("noon"), entry(60)]},
            "2025-12-01": {"hourly": [entry("100"), entry("200")]},
            "some day": {"hourly": [entry("100")]},
        }
    }
    day = dt.datetime(2025, 12, 2)
    expected = [day, day.replace(hour=3), day.replace(hour=23), day, day.replace(hour=1)]
    assert [p[0] for p in points(forecast(spark, "weatherstack", body, hours=6))] == [
        *expected,
        dt.datetime(2025, 12, 1, 1),
    ]
    assert [p[0] for p in points(forecast(spark, "weatherstack", body, hours=99))][-1] == FETCHED


def test_weatherstack_forecast_with_an_impossible_hour_is_lost(spark):
    body = {"forecast": {"2025-12-02": {"hourly": [{"time": "2400", "temperature": 1}]}}}
    assert forecast(spark, "weatherstack", body).first()["reject_reason"] == "bad_time"


@pytest.mark.parametrize("hours, kept", [(0, False), (1, True), (168, True), (169, False), (None, True)])
def test_hours_are_checked(spark, hours, kept):
    reason = forecast(spark, "weatherbit", {"data": []}, hours=hours).first()["reject_reason"]
    assert (reason is None) == kept


def test_forecast_points_are_flat(spark):
    body = {"data": [{"temp": 1, "timestamp_utc": "2025-12-01T01:00:00"}]}
    row = forecast_points(accepted(forecast(spark, "weatherbit", body))).first()
    assert (row.provider, row.time, row.temperature_c) == ("weatherbit", dt.datetime(2025, 12, 1, 1), 1.0)


def test_mean_of_two_and_one_failing(spark):
    om = ("open_meteo", {"current_weather": {"temperature": 10, "windspeed": 5}})
    ow = ("openweathermap", {"main": {"temp": 20, "humidity": 70}})
    bad = ("weatherstack", {"error": {}})
    row = nest_current(accepted(current(spark, ow, bad, om))).first()
    assert [s.provider for s in row.samples] == ["open_meteo", "openweathermap"]
    assert row.average_temperature_c == 15.0
    assert row.average_humidity == 70.0
    alone = nest_current(accepted(current(spark, om, bad))).first()
    assert (len(alone.samples), alone.average_temperature_c, alone.average_humidity) == (1, 10.0, None)


def test_nesting_and_exploding_gives_the_samples_back(spark):
    samples = accepted(current(spark, *[(p, b) for p, b, _ in GOLDEN]))
    docs = to_documents(nest_current(samples), "current")
    body = json.loads(docs.first()["response"])
    assert body["samples"][1]["raw"]["main"]["temp"] == 31.75
    assert body["samples"][0]["observation_time"] == GOLDEN[0][2][4].isoformat(timespec="microseconds")
    exploded = explode_samples(docs.withColumnRenamed("_id", "weather_id"))
    found = {r[0]: float(r[1]) for r in exploded.select("sample.provider", "sample.temperature_c").collect()}
    assert found == {r.provider: r.temperature_c for r in samples.collect()}


def test_a_payload_is_parsed_once(spark):
    landed = spark.createDataFrame([("r", "weatherbit", 1.0, 2.0, 24, FETCHED, "{}")], LANDING_FORECAST)
    for normalized, parses in (
        (normalize_forecast(landed), 2),  # one for listed days, one for dated days; a row takes one of them
        (normalize_current(landed.drop("hours")), 1),
    ):
        plan = accepted(normalized)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == parses


def test_forecasts_are_nested_twice(spark):
    body = {"data": [{"temp": 1, "timestamp_utc": "2025-12-01T01:00:00"}]}
    doc = to_documents(nest_forecast(accepted(forecast(spark, "weatherbit", body))), "forecast").first()
    assert json.loads(doc.request) == {"lat": 52.52, "lon": 13.405, "hours": 24}
    assert json.loads(doc.response)["forecasts"] == [
        {"provider": "weatherbit", "points": [{"time": "2025-12-01T01:00:00.000000", "temperature_c": 1.0}]}
    ]
