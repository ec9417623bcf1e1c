"""Marts, scores and streams that are kept up to date by day, against full rebuilds."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from veriscope.bindings import adapters as A
from veriscope.operators.anomalies import outside_window, scores_from_parts, volume_anomalies
from veriscope.operators.keyed import scd2_changes
from veriscope.operators.normalize import accepted, normalize_current, rejected
from veriscope.operators.nest import nest_current
from veriscope.operators.quality import Check, run_checks
from veriscope.plans import dm, jobs, ods
from veriscope.sources.documents import append_documents
from veriscope.sources.warehouse import Warehouse
from veriscope.streaming.ingest import stream_ingest

from .conftest import SF_DIR
from .test_jobs import MARTS, NOW, content, every_city

SEEN, FORECASTS = "ods.weather_observations", "ods.weather_forecasts"
PARTS = [*dm.ACCURACY_PARTS, *dm.CITY_PARTS]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def opened_days(df):
    """Days that the scans' filters on day folders name."""
    return set(re.findall(r"20\d\d-\d\d-\d\d", "".join(re.findall(r"PartitionFilters: \[[^]]*\]", plan(df)))))


@pytest.fixture(scope="module")
def models(spark):
    seen = ods.ods_observations(A.observations(spark, SF_DIR)).cache()
    guessed = ods.ods_forecasts(A.forecasts(spark, SF_DIR)).filter("forecast_timestamp < timestamp_ntz'2024-01-07'").cache()
    return seen, guessed


def stored(spark, folder, seen, guessed):
    warehouse = Warehouse(spark, str(folder))
    warehouse.overwrite(SEEN, seen, "observation_time", "source_changed_at")
    warehouse.overwrite(FORECASTS, guessed, "forecast_timestamp", "source_changed_at")
    return warehouse


def marts(warehouse):
    return {t: content(warehouse, t) for t in MARTS}


def upserted(warehouse, table, rows):
    key, day = (ods.OBSERVATION_KEY, "observation_time") if table == SEEN else (ods.FORECAST_KEY, "forecast_timestamp")
    warehouse.upsert(table, rows, key, day, "source_changed_at")


def test_marts_after_three_loads_equal_a_rebuild_and_open_changed_days_only(spark, models, tmp_path, monkeypatch):
    seen, guessed = models
    before = lambda rows, time, day: rows.filter(f"{time} < timestamp_ntz'2024-01-{day:02}'")
    warehouse = stored(spark, tmp_path / "w", before(seen, "observation_time", 4), before(guessed, "forecast_timestamp", 4))
    jobs.build(warehouse, None, layers=["dm"])
    read, real = [], Warehouse.read

    def noted(self, table, *args, **options):
        rows = real(self, table, *args, **options)
        if table in (SEEN, FORECASTS):
            read.append(opened_days(rows))
        return rows

    loads = [
        (SEEN, seen.filter("observation_time >= timestamp_ntz'2024-01-04' AND observation_time < timestamp_ntz'2024-01-06'"), {"2024-01-04", "2024-01-05"}),
        (FORECASTS, guessed.filter("forecast_timestamp >= timestamp_ntz'2024-01-05' AND forecast_timestamp < timestamp_ntz'2024-01-06'"), {"2024-01-05"}),
        # Corrections: other temperatures, and hours whose temperature turns out to be unknown.
        (
            SEEN,
            seen.filter("cast(observation_time AS date) = date'2024-01-02'").withColumn(
                "temperature_celsius", F.expr("CASE WHEN hour(observation_time) < 12 THEN temperature_celsius + 40 END")
            ),
            {"2024-01-02"},
        ),
    ]
    for table, rows, days in loads:
        upserted(warehouse, table, rows)
        read.clear()
        monkeypatch.setattr(Warehouse, "read", noted)
        jobs.build(warehouse, None, layers=["dm"])
        monkeypatch.setattr(Warehouse, "read", real)
        assert read and all(found == days for found in read)
    kept = marts(warehouse)
    read.clear()
    monkeypatch.setattr(Warehouse, "read", noted)
    jobs.build(warehouse, None, layers=["dm"])  # nothing has changed since
    monkeypatch.setattr(Warehouse, "read", real)
    assert not read and marts(warehouse) == kept
    jobs.build(warehouse, None, layers=["dm"], full_refresh=True)
    assert marts(warehouse) == kept
    whole = dm.dm_forecast_accuracy(warehouse.read(SEEN), warehouse.read(FORECASTS)).drop("dbt_updated_at")
    assert sorted(map(str, whole.collect())) == kept["dm.forecast_accuracy"]
    city = dm.dm_city_summary(warehouse.read(SEEN)).drop("dbt_updated_at")
    assert sorted(map(str, city.collect())) == kept["dm.city_summary"]


def test_a_day_that_lost_its_rows_leaves_the_partials(spark, models, tmp_path):
    seen, guessed = models
    some = seen.filter("observation_time < timestamp_ntz'2024-01-04'"), guessed.filter("forecast_timestamp < timestamp_ntz'2024-01-04'")
    warehouse = stored(spark, tmp_path, *some)
    jobs.build(warehouse, None, layers=["dm"])
    unknown = some[0].filter("cast(observation_time AS date) = date'2024-01-02'")
    upserted(warehouse, SEEN, unknown.withColumn("temperature_celsius", F.lit(None).cast("double")))
    jobs.build(warehouse, None, layers=["dm"])
    assert not any(path.name == "part_day=2024-01-02" for path in (tmp_path / "parts" / "accuracy").iterdir())
    whole = dm.dm_forecast_accuracy(warehouse.read(SEEN), warehouse.read(FORECASTS)).drop("dbt_updated_at")
    assert sorted(map(str, whole.collect())) == content(warehouse, "dm.forecast_accuracy")


@pytest.mark.parametrize("failing", [3, 5])
def test_a_mart_run_that_fails_at_any_write_is_made_good(spark, models, tmp_path, monkeypatch, failing):
    seen, guessed = models
    some = seen.filter("observation_time < timestamp_ntz'2024-01-03'"), guessed.filter("forecast_timestamp < timestamp_ntz'2024-01-03'")
    warehouse = stored(spark, tmp_path, *some)
    jobs.build(warehouse, None, layers=["dm"])
    upserted(warehouse, SEEN, some[0].filter("cast(observation_time AS date) = date'2024-01-02'").withColumn("temperature_celsius", F.lit(7.0)))
    calls, real = [0], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        calls[0] += 1
        if calls[0] == failing:
            raise OSError("the cluster went away")
        return real(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    with pytest.raises(OSError):
        jobs.build(warehouse, None, layers=["dm"])
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    jobs.build(warehouse, None, layers=["dm"])
    whole = dm.dm_forecast_accuracy(warehouse.read(SEEN), warehouse.read(FORECASTS)).drop("dbt_updated_at")
    assert sorted(map(str, whole.collect())) == content(warehouse, "dm.forecast_accuracy")


def test_median_of_partials_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for day in range(1, 8):
        for lead, values in ((1, [rng.expovariate(0.3) for _ in range(101)]), (3, [2.0] * 30 + [5.0] * 30), (6, [rng.choice([0.5, 1e12, 3e15])])):
            rows += [("p", lead, dt.datetime(2024, 1, day, 5), "c", v, v, v, v * v, v * v) for v in values]
    rows += [(None, 1, dt.datetime(2024, 1, 1), None, None, None, None, None, None)]
    schema = """provider string, hours_ahead_interval int, forecast_timestamp timestamp_ntz, city string, temperature_error_abs double,
        humidity_error_abs double, wind_speed_error_abs double, temperature_squared_error double, humidity_squared_error double"""
    errors = spark.createDataFrame(rows, schema)
    parts = dm.accuracy_parts(errors)
    found = dm.accuracy_from_parts(*(parts[p] for p in dm.ACCURACY_PARTS)).drop("dbt_updated_at").collect()
    expected = dm.accuracy_of(errors).drop("dbt_updated_at").collect()
    assert sorted(map(str, found)) == sorted(map(str, expected)) and len(found) == 4


# Reads and writes by day


def test_an_hourly_run_opens_folders_with_changes_only(spark, tmp_path, monkeypatch):
    """Three loads; in the third one a few documents of an early day change, which the index of days finds."""
    docs = {kind: A.documents(spark, SF_DIR, kind).filter("created_at < timestamp_ntz'2024-01-06'").cache() for kind in ("current", "forecast")}
    warehouse, cities = Warehouse(spark, str(tmp_path)), every_city(spark)
    late = "created_at >= timestamp_ntz'2024-01-05'"
    for kind, rows in docs.items():
        warehouse.scd2_load(kind, rows.filter(f"NOT ({late})"), NOW)
    jobs.build(warehouse, cities)
    read, real = {}, Warehouse.read

    def noted(self, table, *args, **options):
        rows = real(self, table, *args, **options)
        read.setdefault(table, set()).update(opened_days(rows))
        return rows

    for kind, rows in docs.items():
        changed = rows.filter("created_at >= timestamp_ntz'2024-01-02' AND created_at < timestamp_ntz'2024-01-02 06:00:00'")
        changed = changed.withColumn("updated_at", F.expr("timestamp_ntz'2024-02-01 00:00:00'"))
        warehouse.scd2_load(kind, rows.filter(late).unionByName(changed), NOW + dt.timedelta(hours=1))
    monkeypatch.setattr(Warehouse, "read", noted)
    jobs.build(warehouse, cities, layers=["stg", "ods"])
    monkeypatch.setattr(Warehouse, "read", real)
    # The day of the newest stamp of the first load is opened again: its stamp is the watermark.
    assert read["raw.weather_current"] and read["raw.weather_current"] <= {"2024-01-02", "2024-01-04", "2024-01-05"}
    for table in ("stg.weather_current", "stg.weather_forecast"):
        days = sorted(str(d) for d in warehouse.index(table) if d)
        assert read[table] and read[table] < set(days)
    assert "2024-01-02" in read["stg.weather_current"]


def test_staged_files_are_moved_not_written_again(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, d), 1) for k in "ab" for d in (1, 2, 3)], "k string, day timestamp_ntz, v int")
    warehouse.overwrite("ods.t", rows, "day")
    written_to, real = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        written_to.append(path)
        return real(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    warehouse.upsert("ods.t", rows.filter("day > timestamp_ntz'2024-01-01'").withColumn("v", F.lit(2)), ["k", "day"], "day")
    assert [p.removeprefix(str(tmp_path)) for p in written_to] == ["/_batch/ods.t", "/_staging/ods.t"]
    assert sorted(map(tuple, warehouse.read("ods.t").select("k", F.dayofmonth("day"), "v").collect())) == [
        (k, d, 1 if d == 1 else 2) for k in "ab" for d in (1, 2, 3)
    ]
    assert {d.day: x.write for d, x in warehouse.index("ods.t").items()} == {1: 1, 2: 2, 3: 2}


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_publish_cut_short_between_days_is_gone_on_with(spark, tmp_path, monkeypatch, moved):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, d), 1) for k in "ab" for d in (1, 2)], "k string, day timestamp_ntz, v int")
    warehouse.overwrite("ods.t", rows, "day")
    warehouse.overwrite("dm.m", rows.select("k"))
    real, calls = Warehouse._move, [0]

    def move(self, *args):
        if calls[0] == moved:
            raise OSError("the driver died")
        calls[0] += 1
        real(self, *args)

    monkeypatch.setattr(Warehouse, "_move", move)
    for table, key, day in (("ods.t", ["k", "day"], "day"), ("dm.m", ["k"], None)):
        calls[0] = 0
        batch = rows.withColumn("v", F.lit(2)) if day else spark.createDataFrame([("z",)], "k string")
        try:
            warehouse.upsert(table, batch, key, day)
        except OSError:
            pass
    monkeypatch.setattr(Warehouse, "_move", real)
    warehouse.recover(["ods.t", "dm.m"])
    assert sorted(map(tuple, warehouse.read("ods.t").select("k", F.dayofmonth("day"), "v").collect())) == [(k, d, 2) for k in "ab" for d in (1, 2)]
    assert sorted(r.k for r in warehouse.read("dm.m").collect()) == ["a", "a", "b", "b", "z"]
    assert not (tmp_path / "_staging" / "ods.t").exists()


# Streams


def test_a_stream_to_ods_equals_the_batch_job_in_any_order_of_arrival(spark, tmp_path):
    cities = every_city(spark)
    docs = A.documents(spark, SF_DIR, "current").filter("created_at < timestamp_ntz'2024-01-08'").cache()
    # Every fifth document changed later: other words, a later stamp.
    changed = docs.filter("cast(_id AS bigint) % 5 = 0").withColumn("updated_at", F.expr("updated_at + interval 3 days"))
    changed = changed.withColumn("response", F.regexp_replace("response", '"condition":"W', '"condition":"X'))
    log = docs.unionByName(changed)
    batch = Warehouse(spark, str(tmp_path / "batch"))
    batch.scd2_load("current", log, NOW)
    jobs.build_arrived(batch, cities, "current")
    stream, folder = Warehouse(spark, str(tmp_path / "stream")), str(tmp_path / "docs")
    cuts = ["2024-01-06", "2024-01-03", "2023-01-01"]  # the latest arrive first
    last = "2100-01-01"
    for cut in cuts:
        append_documents(log.filter(f"updated_at >= timestamp_ntz'{cut}' AND updated_at < timestamp_ntz'{last}'"), folder, "current")
        last = cut
        query = stream_ingest(
            stream, "current", folder, str(tmp_path / "c"), files_per_batch=2, clock=lambda: NOW, cities=cities
        )
        query.awaitTermination()
    for table in ("stg.weather_current", SEEN):
        drop = ["processed_dttm", "valid_from_dttm"]
        found, expected = (sorted(map(str, w.read(table).drop(*drop).collect())) for w in (stream, batch))
        assert found == expected and found


def test_an_older_version_does_not_replace_a_newer_one_going_forward(spark):
    active = spark.createDataFrame([("a", 5), ("b", 5), ("c", None)], "k string, u int")
    news = spark.createDataFrame([("a", 4), ("b", 6), ("c", 1), ("d", 1)], "k string, u int")
    opened = lambda forward: sorted(r.k for r in scd2_changes(active, news, "k", "u", one_each=True, forward=forward).collect())
    assert opened(False) == ["a", "b", "c", "d"] and opened(True) == ["b", "c", "d"]


# Checks


def test_scores_after_ten_daily_loads_equal_one_full_run(spark, models, tmp_path):
    seen = models[0].filter("observation_time >= timestamp_ntz'2024-01-08' AND observation_time < timestamp_ntz'2024-01-29'")
    # One provider falls silent, one day is strange, and nights are missing.
    seen = seen.filter("NOT (provider = 'weatherbit' AND observation_time >= timestamp_ntz'2024-01-20') AND hour(observation_time) < 21")
    strange = "CASE WHEN cast(observation_time AS date) = date'2024-01-24' THEN temperature_celsius + 500 ELSE temperature_celsius END"
    seen = seen.withColumn("temperature_celsius", F.expr(strange)).cache()
    day = F.dayofmonth("observation_time")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.overwrite(SEEN, seen.filter(day <= 18), "observation_time", "source_changed_at")
    jobs.score_observations(warehouse)
    for d in range(19, 29):
        upserted(warehouse, SEEN, seen.filter(day == d))
        jobs.score_observations(warehouse)
    whole = Warehouse(spark, str(tmp_path / "whole"))
    whole.overwrite(SEEN, seen, "observation_time", "source_changed_at")
    expected = sorted(map(str, jobs.score_observations(whole).collect()))
    assert sorted(map(str, jobs.score_observations(warehouse).collect())) == expected
    assert {r.kind for r in jobs.score_observations(whole).filter("is_anomaly").collect()} >= {"dimension", "column"}


def test_a_correction_of_an_early_day_scores_what_follows_again(spark, models, tmp_path):
    seen = models[0]
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.overwrite(SEEN, seen, "observation_time", "source_changed_at")
    jobs.score_observations(warehouse)
    upserted(warehouse, SEEN, seen.filter("dayofmonth(observation_time) = 9").withColumn("temperature_celsius", F.lit(900.0)))
    found = sorted(map(str, jobs.score_observations(warehouse).collect()))
    parts = warehouse.read("parts.observation_hours")
    assert found == sorted(map(str, scores_from_parts(parts, "provider").collect()))


def test_a_stray_stamp_makes_no_buckets(spark):
    rows = [(dt.datetime(2024, 1, 1, h),) for h in range(5)] + [(dt.datetime(9999, 1, 1),), (dt.datetime(1900, 1, 1),), (None,)]
    stamped = spark.createDataFrame(rows, "t timestamp_ntz")
    assert volume_anomalies(stamped, "t", "hour").count() == 5
    assert sorted(r.reject_reason for r in outside_window(stamped, "t").collect()) == ["no_time", "too_early", "too_late"]


def test_all_checks_of_a_model_share_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "n int, s string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    checks = [
        Check("t", "n", "not_null"),
        Check("t", "n", "unique"),
        Check("t", "s", "unique"),
        Check("t", "s", "accepted_values", values=("a",)),
        Check("t", "n", "expression", expression="> 1"),
    ]
    results = run_checks({"t": rows}, checks)
    assert plan(results).count("FileScan") == 1
    assert {(r["check"], r.failures) for r in results.collect()} == {
        ("not_null_t_n", 1), ("unique_t_n", 1), ("unique_t_s", 0), ("accepted_values_t_s", 1), ("expression_t_n_> 1", 2)
    }


def test_checks_of_an_empty_model_pass(spark):
    rows = spark.createDataFrame([], "n int")
    checks = [Check("t", "n", "not_null"), Check("t", "n", "unique")]
    assert [r.failures for r in run_checks({"t": rows}, checks).collect()] == [0, 0]


# Nesting


def test_a_request_without_id_is_rejected_and_a_replayed_one_keeps_its_latest_answers(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    body = lambda t: f'{{"data": [{{"temp": {t}}}]}}'
    landed = [("r", "weatherbit", 1.0, 2.0, at(i), body(i)) for i in range(500)]
    landed += [(None, "weatherbit", 1.0, 2.0, at(i), body(i)) for i in range(400)]
    landed += [("r", "open_meteo", 1.0, 2.0, at(3), '{"current_weather": {"temperature": 5}}')]
    schema = "request_id string, provider string, latitude double, longitude double, fetched_at timestamp_ntz, payload string"
    normalized = normalize_current(spark.createDataFrame(landed, schema), keep_raw=False)
    assert {(r.reject_reason, r["count"]) for r in rejected(normalized).groupBy("reject_reason").count().collect()} == {("no_request", 400)}
    nested = nest_current(accepted(normalized))
    row = nested.collect()
    assert len(row) == 1 and [(s.provider, s.temperature_c) for s in row[0].samples] == [("open_meteo", 5.0), ("weatherbit", 499.0)]
    assert row[0].average_temperature_c == 252.0 and row[0].fetched_at == at(499)
    assert "partial_max_by" in plan(nested)
