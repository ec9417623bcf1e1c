"""The jobs: load documents, build the layers, check them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import ntz
from ..operators.anomalies import PART_TIME, hour_parts, run_metrics, scores_from_parts
from ..schemas import FORECAST_PROVIDERS, ODS_EPOCH, RAW_EPOCH
from ..session import written
from ..sources.documents import changed_documents, read_documents, read_since
from ..sources.warehouse import Days, LoadCounts, Warehouse
from . import dm, ods, stg
from .checks import check_layers

MODELS = [
    "raw.weather_current",
    "raw.weather_forecast",
    "stg.weather_current",
    "stg.weather_forecast",
    "ods.weather_observations",
    "ods.weather_forecasts",
    "dm.forecast_accuracy",
    "dm.provider_ranking",
    "dm.city_summary",
]


class ChecksFailed(RuntimeError):
    """At least one check of severity error failed."""


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load_kind(
    warehouse: Warehouse, kind: str, documents: DataFrame, now: dt.datetime | None = None, shift_days: int = 1
) -> LoadCounts:
    """Loads documents changed since the newest loaded stamp less ``shift_days``."""
    newest = warehouse.watermark(f"raw.weather_{kind}")
    since = RAW_EPOCH if newest is None else newest - dt.timedelta(days=shift_days)
    return warehouse.scd2_load(kind, changed_documents(documents, since), now or utc_now())


def ingest(
    warehouse: Warehouse, documents: dict[str, str], fmt: str = "parquet", now: dt.datetime | None = None
) -> dict[str, LoadCounts]:
    """Loads the document folders of both kinds into the raw tables; how many were inserted and skipped, by kind."""
    return {
        kind: load_kind(warehouse, kind, read_documents(warehouse.spark, documents[kind], kind, fmt), now)
        for kind in ("current", "forecast")
    }


STG = {
    "current": (
        stg.stg_current,
        "updated_at",
        ["weather_id", "provider", "observation_time"],
        "source_updated_at",
        ods.OBSERVATION_CHANGED_AT,
    ),
    "forecast": (
        stg.stg_forecast,
        "created_at",
        ["forecast_id", "provider", "forecast_timestamp"],
        "forecast_created_at",
        ods.FORECAST_CHANGED_AT,
    ),
}
ODS = {
    "current": (
        "ods.weather_observations",
        ods.ods_observations,
        ods.OBSERVATION_CHANGED_AT,
        "updated_at",
        ods.OBSERVATION_KEY,
        "observation_time",
    ),
    "forecast": (
        "ods.weather_forecasts",
        ods.ods_forecasts,
        ods.FORECAST_CHANGED_AT,
        "forecast_created_at",
        ods.FORECAST_KEY,
        "forecast_timestamp",
    ),
}


def _unread(warehouse: Warehouse, table: str, source: str) -> list[dt.date | None]:
    """Days of the source written after the table was last made of it."""
    return warehouse.touched_since(source, warehouse.made_of(table).get(source, 0))


def _build_stg(warehouse: Warehouse, cities: DataFrame, full: bool, kinds: Sequence[str] = tuple(STG), by_write: bool = False) -> None:
    """``by_write`` takes whole days that were written since, whatever the stamps in them, so late arrivals count too."""
    for kind in kinds:
        build, changed, key, stamp, asked_by = STG[kind]
        source, table, day = f"raw.weather_{kind}", f"stg.weather_{kind}", key[-1]
        fresh = full or not warehouse.exists(table)
        since = None if fresh or by_write else warehouse.watermark(table)
        writes = {source: warehouse.last_write(source)}
        if by_write and not fresh:
            days = _unread(warehouse, table, source)
            if not days:
                continue
            raw = warehouse.read(source, days=days)
        elif changed == "created_at":
            # The raw tables are divided by day of creation: that is one of the stamps, the index of days finds the other.
            raw = warehouse.read(source, from_day=since.date() if since else None)
        else:
            raw = warehouse.read(source, days=warehouse.changed_since(source, since))
        rows = build(read_since(raw, changed, since), cities)
        if fresh:
            warehouse.overwrite(table, rows, day, stamp, asked_by)
        else:
            warehouse.upsert(table, rows, key, day, stamp, changed=asked_by)
        warehouse.note_made_of(table, writes)


def _build_ods(warehouse: Warehouse, full: bool, kinds: Sequence[str] = tuple(ODS), by_write: bool = False) -> None:
    for kind in kinds:
        table, build, changed_at, first, key, day = ODS[kind]
        source = f"stg.weather_{kind}"
        fresh = full or not warehouse.exists(table)
        writes = {source: warehouse.last_write(source)}
        if fresh:
            warehouse.overwrite(table, build(warehouse.read(source)), day, "source_changed_at")
        elif by_write:
            # Both are divided by the same time, so a day here depends on that day there alone.
            days = _unread(warehouse, table, source)
            if days:
                warehouse.replace_days(table, build(warehouse.read(source, days=days)), day, days, stamp="source_changed_at")
        else:
            since = warehouse.watermark(table) or ODS_EPOCH
            # Days without such a change are not opened.
            rows = warehouse.read(source, days=warehouse.changed_since(source, since))
            # The first column is what the files know a range of; it lets whole row groups be skipped.
            rows = rows.filter(f"{first} IS NULL OR {first} >= {ntz(since)}")
            rows = rows.filter(f"{changed_at} >= {ntz(since)}")
            # Unique by construction: the model keeps one row per key.
            warehouse.upsert(table, build(rows), key, day, "source_changed_at")
        warehouse.note_made_of(table, writes)


def build_arrived(warehouse: Warehouse, cities: DataFrame, kind: str) -> None:
    """Staging and operational tables of one kind, from the days that were written since, in whatever order they came."""
    warehouse.recover([f"raw.weather_{kind}", f"stg.weather_{kind}", ODS[kind][0]])
    _build_stg(warehouse, cities, False, [kind], by_write=True)
    _build_ods(warehouse, False, [kind], by_write=True)


SEEN, FORECASTS = "ods.weather_observations", "ods.weather_forecasts"


def _touched(warehouse: Warehouse, sources: Sequence[str], parts: Sequence[str], full: bool) -> Days | None:
    """Days of the sources that were written after the parts were made of them; None: all, the parts are made anew."""
    if full or not all(warehouse.exists(p) for p in parts):
        return None
    made = warehouse.made_of(parts[0])
    return sorted({d for s in sources for d in warehouse.touched_since(s, made.get(s, 0))}, key=str)


def _build_parts(warehouse: Warehouse, full: bool) -> None:
    """Day partials of the marts, for the days that changed; a day's partials depend on that day of the sources alone."""
    plans = [
        ((SEEN, FORECASTS), dm.ACCURACY_PARTS, lambda seen, forecasts: dm.accuracy_parts(dm.errors_of(seen, forecasts))),
        ((SEEN,), dm.CITY_PARTS, lambda seen: {dm.CITY_PARTS[0]: dm.city_parts(seen)}),
    ]
    for sources, parts, make in plans:
        days = _touched(warehouse, sources, parts, full)
        if days == []:
            continue
        writes = {s: warehouse.last_write(s) for s in sources}
        made = make(*(warehouse.read(s, days=days) for s in sources))
        for part, rows in made.items():
            order = ["bin"] if "bin" in rows.columns else []
            if days is None:
                warehouse.overwrite(part, rows, dm.PART_TIME, order=order)
            else:
                warehouse.replace_days(part, rows, dm.PART_TIME, days, order)
        # Last of all: a run that was cut short makes the same days again.
        warehouse.note_made_of(parts[0], writes)


def _build_dm(warehouse: Warehouse, full: bool) -> None:
    def publish(table: str, rows: DataFrame, unique: Sequence[str] = ()) -> None:
        # A mart is made of all partials, so it is replaced as a whole and equals a rebuild.
        if full:
            warehouse.overwrite(table, rows)
        else:
            warehouse.replace(table, rows, unique)

    _build_parts(warehouse, full)
    accuracy = dm.accuracy_from_parts(*(warehouse.read(p) for p in dm.ACCURACY_PARTS))
    publish("dm.forecast_accuracy", accuracy)
    publish("dm.provider_ranking", dm.dm_provider_ranking(warehouse.read("dm.forecast_accuracy")))
    # Grouped by city and country but keyed by city: a city in two countries is an error.
    publish("dm.city_summary", dm.city_from_parts(warehouse.read(dm.CITY_PARTS[0])), ["city"])


def build(
    warehouse: Warehouse,
    cities: DataFrame,
    layers: Sequence[str] = ("stg", "ods", "dm"),
    full_refresh: bool = False,
) -> None:
    """Builds the chosen layers in order, from what is new or, with ``full_refresh``, from everything."""
    for layer in layers:
        if layer not in ("stg", "ods", "dm"):
            raise ValueError(f"unknown layer {layer}")
    warehouse.recover([*MODELS, *dm.ACCURACY_PARTS, *dm.CITY_PARTS])
    if "stg" in layers:
        _build_stg(warehouse, cities, full_refresh)
    if "ods" in layers:
        _build_ods(warehouse, full_refresh)
    if "dm" in layers:
        _build_dm(warehouse, full_refresh)


def score_observations(warehouse: Warehouse) -> DataFrame:
    """Anomaly scores of the observations, kept and brought up to date.

    Hours of the days that changed are aggregated again, and only the buckets from the first of these days on are scored: a
    bucket's score depends on it and those before.
    """
    parts, scores = "parts.observation_hours", "quality.observation_scores"
    warehouse.recover([parts, scores])
    days = _touched(warehouse, [SEEN], [parts, scores], False)
    if days is None or days:
        writes = {SEEN: warehouse.last_write(SEEN)}
        make = lambda rows: hour_parts(rows, "observation_time", "provider", ["temperature_celsius"])
        dated = [d for d in days or [] if d is not None]  # a row without a time has no bucket
        if days is None:
            warehouse.overwrite(parts, make(warehouse.read(SEEN)), PART_TIME)
            warehouse.overwrite(scores, scores_from_parts(warehouse.read(parts), "provider"), "bucket")
        elif dated:
            warehouse.replace_days(parts, make(warehouse.read(SEEN, days=dated)), PART_TIME, dated)
            # Buckets without rows between the last one scored and the first new one come into being, too.
            scored = [d for d in warehouse.index(scores) if d is not None]
            start = min([*dated, max(scored, default=min(dated))])
            since = dt.datetime.combine(start, dt.time())
            found = written(scores_from_parts(warehouse.read(parts), "provider", since))
            warehouse.replace_days(scores, found, "bucket", [d for d in scored if d >= start])
        warehouse.note_made_of(parts, writes)
    return warehouse.read(scores)


def check(
    warehouse: Warehouse,
    forecast_providers: Sequence[str] = tuple(FORECAST_PROVIDERS),
    raise_on_error: bool = True,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Runs every check over the built layers, keeps results and mart metrics of every run, and fails on errors.

    Returns the results of this run.
    """
    now = now or utc_now()
    models = {name: warehouse.read(name) for name in MODELS}
    warehouse.append("quality.mart_metrics", run_metrics(models["dm.forecast_accuracy"], now, "dbt_updated_at"))
    scores = score_observations(warehouse)
    results = check_layers(models, scores, warehouse.read("quality.mart_metrics"), forecast_providers)
    warehouse.append("quality.results", results.withColumn("checked_at", F.expr(ntz(now))))
    results = warehouse.read("quality.results").filter(f"checked_at = {ntz(now)}")
    failed = results.filter(F.col("status") == "error").select("check", "failures")
    if raise_on_error:
        shown = failed.orderBy("check").collect()  # at most one row per declared check
        if shown:
            raise ChecksFailed("; ".join(f"{r['check']}: {r['failures']}" for r in shown))
    return results
