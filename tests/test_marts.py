"""Marts on small inputs, their properties, and the two ways to a median."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from veriscope.bindings import adapters as A
from veriscope.functions.scalar import c_to_f, pg_round
from veriscope.operators.matching import enrich_city
from veriscope.operators.medians import grouped_median
from veriscope.plans import dm, ods
from veriscope.schemas import CITIES
from veriscope.sources.documents import read_cities, seed_cities

from .conftest import SF_DIR

T0 = dt.datetime(2024, 1, 1, 12)

OBS = """city string, country string, latitude double, longitude double, provider string,
    observation_time timestamp_ntz, temperature_celsius double, humidity_percent double, wind_speed_ms double,
    precipitation_mm double"""
FC = """city string, provider string, forecast_timestamp timestamp_ntz, hours_ahead_interval int,
    temperature_celsius double, humidity_percent double, wind_speed_ms double"""


def observed(spark, *items):
    data = [(c, k, 1.0, 2.0, p, T0 + dt.timedelta(hours=h), t, hum, 1.0, None) for c, k, p, h, t, hum in items]
    return spark.createDataFrame(data, OBS)


def forecast(spark, *items):
    data = [(c, p, T0 + dt.timedelta(hours=h), lead, t, hum, 1.0) for c, p, h, lead, t, hum in items]
    return spark.createDataFrame(data, FC)


def test_accuracy_against_the_mean_of_all_providers(spark):
    seen = observed(spark, ("A", "X", "p1", 0, 10.0, 50.0), ("A", "X", "p2", 0, 14.0, None), ("A", "X", "p1", 1, None, 1.0))
    guessed = forecast(
        spark,
        ("A", "p1", 0, 1, 13.0, 70.0),
        ("A", "p1", 0, 3, 12.0, None),
        ("A", "p1", 1, 1, 9.0, 1.0),  # what was observed is unknown
        ("B", "p1", 0, 1, 9.0, 1.0),  # not observed
    )
    rows = {r.hours_ahead_interval: r for r in dm.dm_forecast_accuracy(seen, guessed).collect()}
    assert set(rows) == {1, 3}
    one, three = rows[1], rows[3]
    assert (one.total_forecasts, one.cities_count, one.temperature_mae, one.temperature_rmse) == (1, 1, 1.0, 1.0)
    assert (one.humidity_mae, one.humidity_accuracy_within_10pct) == (20.0, 0.0)
    # An unknown error counts as a miss.
    assert (three.humidity_mae, three.humidity_accuracy_within_10pct) == (None, 0.0)
    assert (three.temperature_median_error, three.accuracy_within_2deg_pct) == (0.0, 100.0)


@pytest.mark.parametrize("accuracy", [100, 1000, 100_000])
def test_grouped_median_equals_brute_force(spark, accuracy):
    rng = random.Random(accuracy)
    values = {
        "even": [rng.gauss(0, 1) for _ in range(5000)],
        "odd": [rng.random() for _ in range(3001)],
        "ties": [1.0] * 4000 + [2.0] * 4000 + [3.0],
        "two": [1.0, 2.0],
        "one": [5.0],
        None: [4.0, 8.0, None],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    found = {r.k: r.m for r in grouped_median(df, ["k"], "v", "m", accuracy).collect()}
    expected = {k: statistics.median([v for v in vs if v is not None]) for k, vs in values.items()}
    assert found == pytest.approx(expected)


def test_a_missed_median_fails_instead_of_being_wrong(spark, monkeypatch):
    """A sketch that returned a bracket beside the middle must not go unseen."""
    rows = spark.createDataFrame([("a", float(v)) for v in range(5000)], "k string, v double")
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda column, _, accuracy: real(column, [0.9, 0.95], accuracy))
    with pytest.raises(Exception, match="missed its middle"):
        grouped_median(rows, ["k"], "v", "m", 100).collect()


def test_large_numbers_are_left_as_they_are(spark):
    row = spark.range(1).selectExpr(
        f"{c_to_f('1e30D')} AS a", f"{pg_round('-2.5D', 0)} AS b", f"{pg_round('cast(\'inf\' AS double)', 2)} AS c", f"{c_to_f('cast(NULL AS double)')} AS d"
    ).first()
    assert (row.a, row.b, row.c, row.d) == (1e30 * 9 / 5 + 32, -3.0, float("inf"), None)


def test_properties_of_the_marts(spark):
    seen = ods.ods_observations(A.observations(spark, SF_DIR))
    accuracy = dm.dm_forecast_accuracy(seen, ods.ods_forecasts(A.forecasts(spark, SF_DIR))).collect()
    assert all(r.temperature_rmse >= r.temperature_mae and r.humidity_rmse >= r.humidity_mae for r in accuracy)
    assert all(0 <= r.accuracy_within_2deg_pct <= r.accuracy_within_5deg_pct <= 100 for r in accuracy)
    ranking = dm.dm_provider_ranking(spark.createDataFrame(accuracy)).collect()
    for rank in ("overall_rank", "rank_by_temperature_mae", "rank_by_accuracy_2deg", "rank_short_term", "rank_long_term"):
        assert sorted(r[rank] for r in ranking) == list(range(1, len(ranking) + 1))


def test_ranking_puts_unknown_error_last_and_unknown_share_first(spark):
    schema = """provider string, hours_ahead_interval int, total_forecasts bigint, temperature_mae double,
        temperature_rmse double, accuracy_within_2deg_pct double, accuracy_within_5deg_pct double,
        humidity_mae double, wind_speed_mae double"""
    data = [("a", 24, 5, 1.0, 1.0, 50.0, 60.0, 1.0, 1.0), ("b", 1, 5, None, None, None, None, None, None)]
    ranked = {r.provider: r for r in dm.dm_provider_ranking(spark.createDataFrame(data, schema)).collect()}
    assert (ranked["a"].rank_by_temperature_mae, ranked["b"].rank_by_temperature_mae) == (1, 2)
    assert (ranked["a"].rank_by_accuracy_2deg, ranked["b"].rank_by_accuracy_2deg) == (2, 1)
    # Only long horizons: no short-term mean.
    assert ranked["a"].short_term_temperature_mae is None and ranked["a"].long_term_temperature_mae == 1.0


def test_city_summary_of_one_row(spark):
    row = dm.dm_city_summary(observed(spark, ("A", "X", "p1", 0, 10.0, 50.0))).first()
    assert row.stddev_temperature is None and row.temperature_range == 0.0
    assert (row.days_tracked, row.total_observations, row.avg_observations_per_day) == (1, 1, 1.0)
    assert row.total_precipitation is None


def test_column_counts(spark):
    seen, guessed = A.observations(spark, SF_DIR), A.forecasts(spark, SF_DIR)
    o, f = ods.ods_observations(seen), ods.ods_forecasts(guessed)
    accuracy = dm.dm_forecast_accuracy(o, f)
    counts = [len(df.columns) for df in (o, f, accuracy, dm.dm_provider_ranking(accuracy), dm.dm_city_summary(o))]
    assert counts == [25, 27, 15, 19, 23]


def test_a_position_listed_twice_doubles_rows_unless_told_otherwise(spark, tmp_path):
    cities = seed_cities(spark)
    here = spark.createDataFrame([(59.9301, 30.3599), (0.0, 0.0)], "latitude double, longitude double")
    assert enrich_city(here, cities).filter("city = 'Saint Petersburg'").count() == 2
    single = enrich_city(here, cities, dedupe_dimension=True)
    assert sorted(map(str, (r.city for r in single.collect()))) == ["None", "Saint Petersburg"]
    cities.write.option("header", True).csv(str(tmp_path / "cities"))
    assert sorted(map(tuple, read_cities(spark, str(tmp_path / "cities")).collect())) == sorted(CITIES)
