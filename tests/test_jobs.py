"""Quality checks and the jobs from documents to checked marts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veriscope.bindings import adapters as A
from veriscope.operators.anomalies import dimension_anomalies, run_anomalies, run_metrics, volume_anomalies
from veriscope.operators.history import most_recent
from veriscope.operators.keyed import DuplicateKeyError
from veriscope.operators.normalize import normalize_current
from veriscope.operators.quality import Check, failing_city_coordinates, run_checks
from veriscope.plans import jobs
from veriscope.plans.checks import all_checks
from veriscope.schemas import PROVIDERS
from veriscope.sources.documents import append_documents, seed_cities
from veriscope.sources.warehouse import Warehouse
from veriscope.streaming.ingest import stream_ingest

from .conftest import SF_DIR

NOW = dt.datetime(2024, 3, 1)
MARTS = ["dm.forecast_accuracy", "dm.provider_ranking", "dm.city_summary"]
STAMPS = ["processed_dttm", "dbt_updated_at"]


def content(warehouse, table):
    return sorted(map(str, warehouse.read(table).drop(*STAMPS, "valid_from_dttm").collect()))


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """All documents, and the same in two parts, the later created ones in the second."""
    root = tmp_path_factory.mktemp("stores")
    paths = {}
    for kind in ("current", "forecast"):
        docs = A.documents(spark, SF_DIR, kind)
        early = F.col("created_at") < F.lit("2024-01-20").cast("timestamp_ntz")
        for name, part in (("all", docs), ("first", docs.filter(early)), ("second", docs.filter(~early))):
            paths.setdefault(name, {})[kind] = str(root / name / kind)
            append_documents(part, paths[name][kind], kind)
    return paths


def every_city(spark):
    """A city for every position: rows without one are never matched by a key, see below."""
    more = spark.range(25, 30).selectExpr(
        "cast(id AS double) AS latitude", "id + 0.5D AS longitude", "concat('MORE_', id) AS city", "'ELSEWHERE' AS country"
    )
    return A.cities(spark, SF_DIR).unionByName(more)


@pytest.fixture(scope="module")
def whole(spark, stores, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("whole")))
    jobs.ingest(warehouse, stores["all"], now=NOW)
    jobs.build(warehouse, every_city(spark))
    return warehouse


def test_incremental_runs_equal_one_full_run(spark, stores, whole, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    cities = every_city(spark)
    for part in ("first", "second", "second"):
        jobs.ingest(warehouse, stores[part], now=NOW)
        jobs.build(warehouse, cities)
    for table in jobs.MODELS:
        assert content(warehouse, table) == content(whole, table), table
    jobs.build(warehouse, cities, full_refresh=True)
    for table in MARTS:
        assert content(warehouse, table) == content(whole, table), table


def test_layers_can_be_built_alone(spark, whole):
    before = content(whole, "dm.city_summary")
    jobs.build(whole, every_city(spark), layers=["dm"])
    assert content(whole, "dm.city_summary") == before
    with pytest.raises(ValueError):
        jobs.build(whole, every_city(spark), layers=["mart"])


def test_stream_equals_batch(spark, stores, whole, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for _ in range(2):  # The second run finds no new files.
        for kind in ("current", "forecast"):
            query = stream_ingest(
                warehouse, kind, stores["all"][kind], str(tmp_path / "c" / kind), files_per_batch=20, clock=lambda: NOW
            )
            query.awaitTermination()
    for table in ("raw.weather_current", "raw.weather_forecast"):
        assert content(warehouse, table) == content(whole, table)


def test_checks_report_and_fail(spark, whole):
    results = {r.check: r for r in jobs.check(whole, raise_on_error=False).collect()}
    assert len(results) == len(all_checks()) + 6
    for check in all_checks():
        assert check.name in results
    assert results["unique_ods.weather_observations_observation_id"].status == "pass"
    # One provider is not declared for forecasts.
    assert results["accepted_values_stg.weather_forecast_provider"].failures == 1
    with pytest.raises(jobs.ChecksFailed, match="accepted_values_stg.weather_forecast_provider"):
        jobs.check(whole)
    assert jobs.check(whole, forecast_providers=PROVIDERS).filter("status = 'error'").count() == 0


def test_rows_without_a_city_are_one_group(spark, stores, tmp_path):
    """A rebuilt mart replaces the group without a key as it does any other."""
    warehouse = Warehouse(spark, str(tmp_path))
    jobs.ingest(warehouse, stores["all"], now=NOW)
    for _ in range(2):
        jobs.build(warehouse, A.cities(spark, SF_DIR))
    assert warehouse.read("dm.city_summary").filter("city IS NULL").count() == 1
    results = {r.check: r.status for r in jobs.check(warehouse, raise_on_error=False).collect()}
    assert results["not_null_stg.weather_current_city"] == "error"


def test_a_city_in_two_countries_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([("A", "X"), ("A", "Y")], "city string, country string")
    with pytest.raises(DuplicateKeyError):
        warehouse.upsert("dm.city_summary", rows, ["city"], unique=True)


def test_each_kind_of_check(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (5, None)], "n int, s string")
    parent = spark.createDataFrame([("a",)], "s string")
    checks = [
        Check("t", "n", "not_null"),
        Check("t", "n", "unique", "warn"),
        Check("t", "s", "accepted_values", values=("a",)),
        Check("t", "n", "expression", "warn", expression="> 1"),
        Check("t", "n", "expression", expression="< 5", where="s is not null"),
        Check("t", "s", "relationships", "warn", parent="p", parent_column="s"),
    ]
    found = [(r.failures, r.status) for r in run_checks({"t": rows, "p": parent}, checks).collect()]
    assert sorted(found) == sorted([(1, "error"), (1, "warn"), (1, "error"), (2, "warn"), (0, "pass"), (1, "warn")])


def test_a_quote_in_a_check_is_text(spark):
    rows = spark.createDataFrame([("1",), ("it's",)], "s string")
    checks = [Check("t's", "s", "expression", expression="<> '1'"), Check("t's", "s", "accepted_values", values=("it's",))]
    assert [r.failures for r in run_checks({"t's": rows}, checks).collect()] == [1, 1]


def test_a_dimension_that_falls_silent_is_an_anomaly(spark):
    days = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h), k) for d in range(20) for h in range(8 + d % 2) for k in "ab"]
    rows = [(t, k) for t, k in days if k == "a" or t.day < 15]
    scored = dimension_anomalies(spark.createDataFrame(rows, "t timestamp_ntz, k string"), "t", "k").collect()
    assert min(r.bucket.day for r in scored if r.is_anomaly) == 15
    assert {r.k for r in scored if r.is_anomaly} == {"b"} and len(scored) == 40


def test_a_mart_that_changes_after_eight_runs_is_an_anomaly(spark, tmp_path):
    """Metrics are kept run by run; the newest run is compared with those before it."""
    warehouse = Warehouse(spark, str(tmp_path))
    start = dt.datetime(2024, 1, 1)
    for run in range(9):
        built = start + dt.timedelta(hours=run)
        value = 5.0 + run % 2 if run < 8 else 500.0
        rows = spark.createDataFrame([("p", value, built)], "provider string, mae double, dbt_updated_at timestamp_ntz")
        lag = 60 + run % 2 if run < 8 else 7200
        warehouse.append("quality.mart_metrics", run_metrics(rows, built + dt.timedelta(seconds=lag), "dbt_updated_at"))
        found = run_anomalies(warehouse.read("quality.mart_metrics")).filter("is_anomaly").collect()
        strange = {(r.column_name, r.metric) for r in found}
        assert strange == (set() if run < 8 else {("mae", "min"), ("mae", "max"), ("dbt_updated_at", "lag")})


def test_a_city_at_two_positions(spark):
    assert [r.city for r in failing_city_coordinates(seed_cities(spark)).collect()] == ["Vladivostok"]


def test_a_missing_day_is_an_anomaly(spark):
    days = [d for d in range(20) if d != 15]
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h),) for d in days for h in range(8 + d % 2)]
    scored = volume_anomalies(spark.createDataFrame(rows, "t timestamp_ntz"), "t").collect()
    assert [r.bucket.day for r in scored if r.is_anomaly] == [16]
    assert len(scored) == 20


def test_listing_limits(spark):
    docs = A.table(spark, SF_DIR, "orders")
    with pytest.raises(ValueError):
        most_recent(docs, 0)
    with pytest.raises(ValueError):
        most_recent(docs, 101)
    newest = most_recent(docs, 3, "o_orderdate", "o_orderkey")
    assert newest.count() == 3
    assert "TakeOrderedAndProject" in newest._jdf.queryExecution().executedPlan().toString()


def test_answers_are_made_and_parsed_in_dealt_rows(spark):
    """A file of one row group is one task, so rows are dealt out before they become answers, whole requests together."""
    plan = normalize_current(A.landing_current(spark, SF_DIR, broken=False))._jdf.queryExecution().executedPlan().toString()
    # A plan is printed from its end to its start.
    assert 0 <= plan.index("from_json") < plan.index("Exchange hashpartitioning(nth")
    assert "to_json" not in plan[plan.index("Exchange hashpartitioning(nth") :]
