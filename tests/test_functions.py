"""Scalar functions at their edges."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest

from veriscope.functions.clock import hour_of, iso_time, seconds_between
from veriscope.functions.scalar import (
    bucket_horizon,
    c_to_f,
    lead_hours,
    pg_round,
    ratio,
    surrogate_key,
    wind_cardinal,
)


def value(spark, expression):
    return spark.sql(f"SELECT {expression} AS x").first()["x"]


@pytest.mark.parametrize(
    "degrees, name",
    [
        ("NULL", "Unknown"),
        (-1, "Unknown"),
        (0, "N"),
        (22.5, "N"),
        (22.6, "NE"),
        (180, "S"),
        (337.5, "NW"),
        (337.6, "N"),
        (360, "N"),
        (361, "Unknown"),
    ],
)
def test_wind_cardinal(spark, degrees, name):
    assert value(spark, wind_cardinal(f"cast({degrees} AS double)")) == name


@pytest.mark.parametrize(
    "hours, at",
    [(0.49, None), (0.5, 1), (1.5, 1), (1.51, None), (3.5, 3), (12.0, 12), (47.5, 48), (48.01, 48), (48.6, None)],
)
def test_bucket_horizon(spark, hours, at):
    assert value(spark, bucket_horizon(f"{hours}D")) == at


@pytest.mark.parametrize("x, digits, expected", [(2.675, 2, 2.68), (-0.25, 1, -0.3), (0.15, 1, 0.2), (1.005, 2, 1.01)])
def test_rounding_is_half_away_from_zero(spark, x, digits, expected):
    assert value(spark, pg_round(f"{x}D", digits)) == expected


def test_fahrenheit_and_ratio(spark):
    assert value(spark, c_to_f("36.6D")) == 97.9
    assert value(spark, ratio("1", "0")) is None
    assert value(spark, ratio("1", "4")) == 0.25


def test_lead_hours(spark):
    t = "timestamp_ntz'2024-01-01 {}'".format
    assert value(spark, lead_hours(t("03:30:00"), t("01:00:00"))) == 2.5
    assert value(spark, lead_hours(t("00:00:00"), t("01:00:00"))) == 0.0
    assert value(spark, lead_hours("cast(NULL AS timestamp_ntz)", t("01:00:00"))) == 0.0


def test_surrogate_key(spark):
    found = value(spark, surrogate_key("'a'", "cast(NULL AS string)", "timestamp_ntz'2024-01-01 10:00:00'"))
    assert found == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-2024-01-01 10:00:00").hexdigest()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-12-01", dt.datetime(2025, 12, 1)),
        ("2025-12-01 14:30", dt.datetime(2025, 12, 1, 14, 30)),
        ("2025-12-01T10:00:00.25+03:00", dt.datetime(2025, 12, 1, 10, 0, 0, 250000)),
        ("2025-12-01T10:00:00Z", dt.datetime(2025, 12, 1, 10)),
        ("2025", None),
        ("2025-13-01", None),
        ("", None),
        ("soon", None),
    ],
)
def test_iso_time(spark, text, expected):
    assert value(spark, iso_time(f"'{text}'")) == expected


def test_clock_ignores_the_zone_of_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 of this day does not exist in that zone.
        gap = "timestamp_ntz'2024-03-10 02:30:00'"
        assert value(spark, hour_of(gap)) == dt.datetime(2024, 3, 10, 2)
        assert value(spark, seconds_between("timestamp_ntz'2024-03-10 01:00:00'", gap)) == 5400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
