"""Keyed writes and version histories, as operators and on stored tables."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from veriscope.operators.dedup import latest_per_key
from veriscope.operators.keyed import (
    DuplicateKeyError,
    delete_insert,
    merge_upsert,
    scd2_counts,
    scd2_history,
    scd2_upsert,
)
from veriscope.schemas import OPEN_END, document_schema
from veriscope.sources.documents import high_watermark, read_since
from veriscope.sources.warehouse import Warehouse

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 2, 1)
LATER = dt.datetime(2024, 2, 2)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def versions(spark, *items):
    data = [(k, at(u), v, T0, OPEN_END) for k, u, v in items]
    schema = "k string, u timestamp_ntz, v int, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz"
    return spark.createDataFrame(data, schema)


def batch(spark, *items):
    return spark.createDataFrame([(k, at(u), v) for k, u, v in items], "k string, u timestamp_ntz, v int")


def spans(df):
    return sorted((r.k, r.v, r.valid_from_dttm, r.valid_to_dttm) for r in df.collect())


def test_scd2_new_unchanged_changed_and_unknown_stamp(spark):
    target = versions(spark, ("same", 1, 1), ("changed", 1, 1), ("gone", 1, 1), ("null", None, 1))
    news = batch(spark, ("same", 1, 9), ("changed", 2, 2), ("new", 1, 1), ("null", None, 9))
    after = scd2_upsert(target, news, "k", "u", NOW)
    assert spans(after) == [
        ("changed", 1, T0, NOW),
        ("changed", 2, NOW, OPEN_END),
        ("gone", 1, T0, OPEN_END),
        ("new", 1, NOW, OPEN_END),
        ("null", 1, T0, OPEN_END),
        ("same", 1, T0, OPEN_END),
    ]
    assert tuple(scd2_counts(target, news, "k", "u").first()) == (2, 2)


def test_scd2_replay_is_a_no_op(spark):
    target = versions(spark, ("a", 1, 1), ("b", 1, 1))
    news = batch(spark, ("a", 2, 2), ("a", 3, 3), ("c", 1, 1))
    once = scd2_upsert(target, news, "k", "u", NOW)
    assert spans(scd2_upsert(once, news, "k", "u", LATER)) == spans(once)


def test_scd2_several_versions_in_one_batch(spark):
    after = scd2_upsert(versions(spark, ("a", 1, 1)), batch(spark, ("a", 3, 3), ("a", 2, 2)), "k", "u", NOW)
    assert spans(after) == [("a", 1, T0, NOW), ("a", 2, NOW, NOW), ("a", 3, NOW, OPEN_END)]


def test_scd2_older_version_replaces_the_active_one(spark):
    after = scd2_upsert(versions(spark, ("a", 5, 5)), batch(spark, ("a", 2, 2)), "k", "u", NOW)
    assert spans(after) == [("a", 2, NOW, OPEN_END), ("a", 5, T0, NOW)]


def test_history_of_a_hot_key_equals_brute_force(spark):
    rng = random.Random(7)
    log = [("hot" if i % 3 else f"k{i % 50}", T0 + dt.timedelta(seconds=rng.randrange(9_000_000))) for i in range(3000)]
    log += log[:50]
    df = spark.createDataFrame(log, "k string, u timestamp_ntz")
    found = sorted((r.k, r.u, r.valid_to_dttm) for r in scd2_history(df, "k", "u").collect())
    expected = []
    for key in {k for k, _ in log}:
        times = sorted({u for k, u in log if k == key})
        expected += [(key, u, n) for u, n in zip(times, [*times[1:], OPEN_END])]
    assert found == sorted(expected)


def test_delete_insert_keeps_repeated_batch_keys_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    news = spark.createDataFrame([("a", 2), ("a", 3), (None, 2)], "k string, v int")
    assert sorted(map(str, rows(delete_insert(target, news, ["k"])))) == sorted(
        map(str, [(None, 1), (None, 2), ("a", 2), ("a", 3), ("b", 1)])
    )


def test_merge_rejects_repeated_keys_and_keeps_absent_ones(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    good = spark.createDataFrame([("a", 2), ("c", 2)], "k string, v int")
    assert rows(merge_upsert(target, good, ["k"])) == [("a", 2), ("b", 1), ("c", 2)]
    with pytest.raises(DuplicateKeyError):
        merge_upsert(target, good.union(good), ["k"])


def test_latest_per_key_with_null_keys_and_map_side_limit(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 1, 3), (None, None, 4)], "k string, t int, v int")
    latest = latest_per_key(df, ["k"], ["t DESC NULLS FIRST"])
    assert sorted(r.v for r in latest.collect()) == [2, 4]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_watermarks(spark):
    df = batch(spark, ("a", 1, 1), ("b", 48, 2), ("c", None, 3))
    assert high_watermark(df, "u") == at(24)
    assert high_watermark(df.filter("false"), "u") == dt.datetime(1970, 1, 1)
    assert [r.k for r in read_since(df, "u", at(1)).collect()] == ["b"]
    assert sorted(r.k for r in read_since(df, "u", at(1), inclusive=True).collect()) == ["a", "b"]
    assert read_since(df, "u", None).count() == 3


def test_watermark_reaches_the_files(spark, tmp_path):
    batch(spark, ("a", 1, 1), ("b", 48, 2)).write.parquet(str(tmp_path / "t"))
    plan = read_since(spark.read.parquet(str(tmp_path / "t")), "u", at(1))._jdf.queryExecution().executedPlan()
    assert "GreaterThan(u," in plan.toString()


# Stored tables

KEYED = "k string, day timestamp_ntz, v int"


def keyed(spark, *items):
    return spark.createDataFrame([(k, None if d is None else T0 + dt.timedelta(days=d), v) for k, d, v in items], KEYED)


def test_upsert_rewrites_only_the_days_of_the_batch(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.overwrite("ods.t", keyed(spark, ("a", 0, 1), ("b", 1, 1), ("c", 2, 1), ("n", None, 1)), "day")
    untouched = sorted(p.name for p in (tmp_path / "ods" / "t").glob("part_day=2024-01-03/*.parquet"))
    news = keyed(spark, ("b", 1, 2), ("x", 1, 2), ("n", None, 2))
    warehouse.upsert("ods.t", news, ["k", "day"], "day")
    expected = [("a", 0, 1), ("b", 1, 2), ("c", 2, 1), ("n", None, 1), ("n", None, 2), ("x", 1, 2)]
    found = [(r.k, None if r.day is None else (r.day - T0).days, r.v) for r in warehouse.read("ods.t").collect()]
    # A key with a NULL part never matches, so its rows stay.
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert sorted(p.name for p in (tmp_path / "ods" / "t").glob("part_day=2024-01-03/*.parquet")) == untouched


def test_an_interrupted_publish_is_finished(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.overwrite("ods.t", keyed(spark, ("a", 0, 1), ("b", 1, 1)), "day")
    staged = keyed(spark, ("b", 1, 2)).withColumn("part_day", F.col("day").cast("date"))
    staged.write.partitionBy("part_day").parquet(str(tmp_path / "_staging" / "ods.t"))
    warehouse.recover(["ods.t"])
    assert rows(warehouse.read("ods.t").select("k", "v")) == [("a", 1), ("b", 2)]
    assert not (tmp_path / "_staging" / "ods.t").exists()


def test_watermark_of_a_table_never_goes_back(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.overwrite("ods.t", keyed(spark, ("a", 5, 1)), "day", "day")
    warehouse.upsert("ods.t", keyed(spark, ("b", 3, 1)), ["k", "day"], "day", "day")
    assert warehouse.watermark("ods.t") == T0 + dt.timedelta(days=5)
    warehouse.overwrite("ods.t", keyed(spark, ("a", 1, 1)), "day", "day")
    assert warehouse.watermark("ods.t") == T0 + dt.timedelta(days=1)


def documents(spark, *items):
    data = [
        (k, "current", 1.0, 2.0, "{}", f'{{"v": {v}}}', 200, None, at(created), at(updated))
        for k, created, updated, v in items
    ]
    return spark.createDataFrame(data, document_schema("current"))


def stored(warehouse):
    return sorted(
        (r.weather_id, r.response, r.valid_from_dttm, r.valid_to_dttm)
        for r in warehouse.read("raw.weather_current").collect()
    )


def test_raw_load_appends_new_and_closes_changed_documents(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.scd2_load("current", documents(spark, ("a", 0, 0, 1), ("b", 30, 30, 1)), T0)
    second = documents(spark, ("a", 0, 40, 2), ("a", 0, 39, 0), ("b", 30, 30, 9), ("c", 50, 50, 1))
    for moment in (NOW, LATER):  # The second time nothing is left to do.
        warehouse.scd2_load("current", second, moment)
        assert stored(warehouse) == [
            ("a", '{"v": 1}', T0, NOW),
            ("a", '{"v": 2}', NOW, OPEN_END),
            ("b", '{"v": 1}', T0, OPEN_END),
            ("c", '{"v": 1}', NOW, OPEN_END),
        ]
    raw = warehouse.read("raw.weather_current")
    assert raw.select("id").distinct().count() == raw.count() == 4
    assert warehouse.watermark("raw.weather_current") == at(50)


@pytest.mark.parametrize("failing", range(1, 9))
def test_a_load_that_fails_at_any_write_loses_nothing(spark, tmp_path, monkeypatch, failing):
    """One changed document with a late stamp and one new one with an early stamp, and a failure at each write in turn."""
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.scd2_load("current", documents(spark, ("a", 0, 0, 1)), T0)
    second = documents(spark, ("a", 0, 240, 2), ("c", 50, 50, 1))
    calls, real = [0], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        calls[0] += 1
        if calls[0] == failing:
            raise OSError("the cluster went away")
        return real(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    try:
        warehouse.scd2_load("current", second, NOW)
    except OSError:
        pass
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    warehouse.recover(["raw.weather_current"])
    # The rerun reads what changed after the watermark, as the job does.
    since = warehouse.watermark("raw.weather_current")
    warehouse.scd2_load("current", second.filter(F.col("updated_at") > since - dt.timedelta(days=1)), NOW)
    assert stored(warehouse) == [
        ("a", '{"v": 1}', T0, NOW),
        ("a", '{"v": 2}', NOW, OPEN_END),
        ("c", '{"v": 1}', NOW, OPEN_END),
    ]


def test_load_counts(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    both = documents(spark, ("a", 0, 0, 1), ("b", 1, 1, 1))
    assert warehouse.scd2_load("current", both, T0) == (2, 0)
    assert warehouse.scd2_load("current", documents(spark, ("a", 0, 5, 2), ("b", 1, 1, 1)), NOW) == (1, 1)
    assert warehouse.scd2_load("current", both.limit(0), NOW) == (0, 0)


def test_history_keeps_rows_without_key_or_stamp(spark):
    rows = spark.createDataFrame(
        [("a", at(0), 1), ("a", at(2), 2), ("a", at(2), 9), (None, at(1), 3), (None, at(3), 4), ("a", None, 5), (None, None, 6)],
        "k string, t timestamp_ntz, v int",
    )
    found = {r.v: r.valid_to_dttm for r in scd2_history(rows, "k", "t").collect()}
    assert found == {1: at(2), 9: OPEN_END, 3: at(3), 4: OPEN_END, 5: OPEN_END, 6: OPEN_END}


def test_counts_need_no_nested_loop(spark):
    target = spark.createDataFrame([("a", at(0), T0, OPEN_END)], "k string, t timestamp_ntz, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    batch = spark.createDataFrame([("a", at(0)), ("b", at(0))], "k string, t timestamp_ntz")
    counts = scd2_counts(target, batch, "k", "t")
    assert tuple(counts.first()) == (1, 1)
    assert "NestedLoop" not in counts._jdf.queryExecution().executedPlan().toString()


def test_empty_raw_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create_raw("forecast")
    warehouse.create_raw("forecast")
    assert warehouse.read("raw.weather_forecast").count() == 0
    assert warehouse.watermark("raw.weather_forecast") is None
    with pytest.raises(ValueError):
        warehouse.read("raw.weather_current")
