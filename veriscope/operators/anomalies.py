"""Anomaly checks: a metric per time bucket compared with the buckets before it.

A bucket is anomalous if its metric lies more than ``SIGMAS`` sample standard deviations from the
mean of the ``HISTORY`` buckets before it; at least ``MIN_HISTORY`` of them must exist.  Rows are
aggregated to buckets first, so the window sees one row per bucket (and dimension), never raw rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.clock import day_of, hour_of, ntz, plus_hours, seconds_between
from ..functions.scalar import pg_round
from ..schemas import RAW_EPOCH

HISTORY, MIN_HISTORY, SIGMAS = 14, 7, 3.0
DIGITS = 6


BUCKETS = {"hour": hour_of, "day": day_of, "run": lambda ts: ts}
SPANS = ("hour", "day")  # the buckets of a calendar; runs have none between them
WINDOW = (RAW_EPOCH, dt.datetime(2100, 1, 1))  # at most 1.2 million hours


def _settled(x: str) -> str:
    """A statistic without the last bits of its summation, which depend on the order of the rows."""
    return pg_round(pg_round(x, DIGITS + 3), DIGITS)


def score(buckets: DataFrame, value: str = "value", by: Sequence[str] = (), bucket: str = "bucket") -> DataFrame:
    """Adds the history's ``n_history``, ``mean``, ``stddev`` and the verdict ``is_anomaly``."""
    partition = f"PARTITION BY {', '.join(by)} " if by else ""
    past = f"OVER ({partition}ORDER BY {bucket} ROWS BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING)"
    v = f"cast({value} AS double)"
    scored = buckets.selectExpr(
        "*",
        f"count({v}) {past} AS n_history",
        f"{_settled(f'avg({v}) {past}')} AS mean",
        f"{_settled(f'stddev_samp({v}) {past}')} AS stddev",
    )
    away = f"abs({v} - mean)"
    far = f"CASE WHEN stddev = 0 THEN {away} > {10.0**-DIGITS:.{DIGITS}f}D ELSE {away} > {SIGMAS}D * stddev END"
    verdict = f"coalesce(n_history >= {MIN_HISTORY} AND {v} IS NOT NULL AND {far}, false)"
    return scored.selectExpr("*", f"{verdict} AS is_anomaly")


def _fill(ends: DataFrame, period: str) -> DataFrame:
    """Rows with every bucket from ``a`` to ``b``, their first and last ones."""
    days = ends.selectExpr("*", "explode(sequence(cast(a AS date), cast(b AS date), interval 1 day)) AS d")
    if period == "day":
        return days.selectExpr("*", "cast(d AS timestamp_ntz) AS bucket").drop("a", "b", "d")
    hours = days.selectExpr("*", "explode(sequence(0, 23)) AS h")
    hours = hours.selectExpr("*", f"{plus_hours('cast(d AS timestamp_ntz)', 'h')} AS bucket")
    return hours.filter("bucket BETWEEN a AND b").drop("a", "b", "d", "h")


def all_buckets(per_bucket: DataFrame, period: str) -> DataFrame:
    """Every bucket from the first to the last one with rows, also those without; reads one row per bucket."""
    return _fill(per_bucket.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")), period)


def with_gaps(per_bucket: DataFrame, period: str) -> DataFrame:
    """Rows per bucket, with a row of NULLs for every bucket without rows."""
    return all_buckets(per_bucket, period).join(per_bucket, "bucket", "left") if period in SPANS else per_bucket


def in_window(ts: str) -> str:
    """Stamps that can be true; one of the year 9999 would make a bucket for each hour until then."""
    return f"({ts} >= {ntz(WINDOW[0])} AND {ts} < {ntz(WINDOW[1])})"


def outside_window(rows: DataFrame, ts: str) -> DataFrame:
    """Rows that no bucket counts, with the reason ``no_time``, ``too_early`` or ``too_late``."""
    reason = f"CASE WHEN {ts} IS NULL THEN 'no_time' WHEN {ts} < {ntz(WINDOW[0])} THEN 'too_early' ELSE 'too_late' END"
    return rows.filter(f"{ts} IS NULL OR NOT {in_window(ts)}").selectExpr("*", f"{reason} AS reject_reason")


def _per_bucket(rows: DataFrame, ts: str, period: str, *more: str) -> GroupedData:
    if period in SPANS:
        rows = rows.filter(in_window(ts))
    return rows.selectExpr("*", f"{BUCKETS[period](ts)} AS bucket").groupBy("bucket", *more)


def _start(since: dt.datetime, period: str) -> str:
    """Where the history begins that a bucket at ``since`` is compared with."""
    return ntz(since - HISTORY * (dt.timedelta(hours=1) if period == "hour" else dt.timedelta(days=1)))


def _from(buckets: DataFrame, since: dt.datetime | None, period: str) -> DataFrame:
    """Buckets from ``since`` on and their history."""
    return buckets if since is None else buckets.filter(f"bucket >= {_start(since, period)}")


def _volume_scores(counts: DataFrame, period: str, since: dt.datetime | None = None) -> DataFrame:
    full = _from(all_buckets(counts, period), since, period).join(counts, "bucket", "left")
    return score(full.selectExpr("bucket", "coalesce(n, 0) AS value"))


def volume_anomalies(rows: DataFrame, ts: str, period: str = "day") -> DataFrame:
    """Rows per bucket; a bucket without rows counts 0."""
    return _volume_scores(_per_bucket(rows, ts, period).agg(F.expr("count(1) AS n")), period)


def _dimension_scores(counts: DataFrame, dimension: str, period: str, since: dt.datetime | None = None) -> DataFrame:
    last = counts.agg(F.max("bucket")).scalar()
    spans = counts.groupBy(F.col(dimension).alias("_of")).agg(F.min("bucket").alias("a")).withColumn("b", last)
    full = _from(_fill(spans, period), since, period).withColumnRenamed("bucket", "_at")
    same = F.col("_of").eqNullSafe(F.col(dimension)) & (F.col("_at") == F.col("bucket"))
    value = F.coalesce("n", F.lit(0)).alias("value")
    return score(full.join(counts, same, "left").select(F.col("_at").alias("bucket"), F.col("_of").alias(dimension), value), by=[dimension])


def dimension_anomalies(rows: DataFrame, ts: str, dimension: str, period: str = "day") -> DataFrame:
    """Rows per bucket and value of a dimension, each value against its own history.

    Buckets run from a value's first to the last one of all values, so a value that falls silent counts 0.
    """
    return _dimension_scores(_per_bucket(rows, ts, period, dimension).agg(F.expr("count(1) AS n")), dimension, period)


def _freshness_scores(newest: DataFrame, period: str, since: dt.datetime | None = None) -> DataFrame:
    full = _from(all_buckets(newest, period), since, period).join(newest, "bucket", "left")
    so_far = "max(newest) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    if since is not None:  # what was the newest before the buckets looked at
        earlier = newest.filter(f"bucket < {_start(since, period)}")
        full = full.withColumn("_before", earlier.agg(F.max("newest")).scalar())
        so_far = f"greatest({so_far}, _before)"
    end = plus_hours("bucket", "1" if period == "hour" else "24")
    return score(full.selectExpr("bucket", f"cast({seconds_between(so_far, end)} AS double) AS value"))


def freshness_anomalies(rows: DataFrame, ts: str, period: str = "hour") -> DataFrame:
    """Seconds from the newest row so far to the end of each bucket."""
    return _freshness_scores(_per_bucket(rows, ts, period).agg(F.expr(f"max({ts}) AS newest")), period)


def event_freshness_anomalies(rows: DataFrame, event_ts: str, update_ts: str, period: str = "day") -> DataFrame:
    """Longest lag, in seconds, from an event to its update per bucket of updates; unknown for a bucket without any."""
    lag = f"cast({seconds_between(event_ts, update_ts)} AS double)"
    return score(with_gaps(_per_bucket(rows, update_ts, period).agg(F.expr(f"max({lag}) AS value")), period))


METRICS = {
    "zero_count": "cast(count_if({0} = 0) AS double)",
    "null_count": "cast(count_if({0} IS NULL) AS double)",
    "min": "cast(min({0}) AS double)",
    "max": "cast(max({0}) AS double)",
}
NULL_ONLY = ["null_count"]


def _wanted(rows: DataFrame, columns: Sequence[str], metrics: Sequence[str]) -> list[tuple[str, str]]:
    numeric = {f.name for f in rows.schema.fields if f.dataType.typeName() in NUMERIC}
    return [(c, m) for c in columns for m in metrics if c in numeric or m in NULL_ONLY]


def _column_scores(
    wide: DataFrame, wanted: Sequence[tuple[str, str]], period: str, since: dt.datetime | None = None
) -> DataFrame:
    """Scores of ``bucket`` and a column ``m0``, ``m1`` and so on for each of the metrics wanted."""
    if period in SPANS:
        wide = _from(all_buckets(wide, period), since, period).join(wide, "bucket", "left")
    value = lambda i, m: f"coalesce(m{i}, 0.0D)" if m.endswith("count") else f"m{i}"
    cells = ", ".join(
        f"named_struct('column_name', '{c}', 'metric', '{m}', 'value', {value(i, m)})" for i, (c, m) in enumerate(wanted)
    )
    return score(wide.selectExpr("bucket", f"inline(array({cells}))"), by=["column_name", "metric"])


def column_anomalies(
    rows: DataFrame, ts: str, columns: Sequence[str], metrics: Sequence[str] = tuple(METRICS), period: str = "day"
) -> DataFrame:
    """Metrics of columns per bucket, each against its own history; one pass for all of them.

    Columns that hold no numbers have their NULLs counted only.  In a bucket without rows counts are 0 and ends unknown.
    """
    wanted = _wanted(rows, columns, metrics)
    wide = _per_bucket(rows, ts, period).agg(
        *[F.expr(f"{METRICS[m].format(c)} AS m{i}") for i, (c, m) in enumerate(wanted)]
    )
    return _column_scores(wide, wanted, period)


# Kept aggregates: an hour's rows are aggregated once, and what is scored is made of the hours.

PART_TIME = "part_time"
KEPT = "kind string, bucket timestamp_ntz, of string, metric string, value double, n_history long, mean double, stddev double, is_anomaly boolean"


def hour_parts(rows: DataFrame, ts: str, dimension: str, columns: Sequence[str]) -> DataFrame:
    """What the checks of a table add up from: a row per hour and value of a dimension, with its day as ``part_time``."""
    metrics = [F.expr(f"{METRICS[m].format(c)} AS `{c}.{m}`") for c, m in _wanted(rows, columns, tuple(METRICS))]
    counted = [F.expr("count(1) AS n"), F.expr(f"max({ts}) AS newest")]
    return _per_bucket(rows, ts, "hour", dimension).agg(*counted, *metrics).withColumn(PART_TIME, F.expr(day_of("bucket")))


MERGED = {"zero_count": "sum", "null_count": "sum", "min": "min", "max": "max"}


def scores_from_parts(parts: DataFrame, dimension: str, since: dt.datetime | None = None) -> DataFrame:
    """Hourly freshness, daily volume, volume per value and column metrics from kept hours, as one table.

    With ``since`` (the start of a day) only the buckets from then on are scored; they equal those of a run over all.
    """
    hours = parts.groupBy("bucket").agg(F.max("newest").alias("newest"))
    by_day = F.col(PART_TIME).alias("bucket")
    volume = parts.groupBy(by_day).agg(F.sum("n").alias("n"))
    values = parts.groupBy(by_day, dimension).agg(F.sum("n").alias("n"))
    wanted = [tuple(c.split(".")) for c in parts.columns if "." in c]
    merged = [F.expr(f"{MERGED[m]}(`{c}.{m}`) AS m{i}") for i, (c, m) in enumerate(wanted)]
    none = F.lit(None).cast("string")
    scored = {
        "freshness": (_freshness_scores(hours, "hour", since), none, none),
        "volume": (_volume_scores(volume, "day", since), none, none),
        "dimension": (_dimension_scores(values, dimension, "day", since), F.col(dimension).cast("string"), none),
    }
    if wanted:
        wide = parts.groupBy(by_day).agg(*merged)
        scored["column"] = (_column_scores(wide, wanted, "day", since), F.col("column_name"), F.col("metric"))
    result = None
    for kind, (rows, of, metric) in scored.items():
        found = ["n_history", "mean", "stddev", "is_anomaly"]
        one = rows.select(F.lit(kind).alias("kind"), "bucket", of.alias("of"), metric.alias("metric"), F.col("value").cast("double"), *found)
        result = one if result is None else result.unionByName(one)
    return result if since is None else result.filter(f"bucket >= {ntz(since)}")


NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def all_columns_anomalies(rows: DataFrame, ts: str, exclude_prefix: str = "dbt_", period: str = "day") -> DataFrame:
    """:func:`column_anomalies` over every column but the time column and those with the prefix."""
    columns = [c for c in rows.columns if c != ts and not c.startswith(exclude_prefix)]
    return column_anomalies(rows, ts, columns, period=period)


RUN_METRICS = "bucket timestamp_ntz, column_name string, metric string, value double"


def run_metrics(rows: DataFrame, at: dt.datetime, update_ts: str | None = None, exclude_prefix: str = "dbt_") -> DataFrame:
    """Metrics of a table at one run, to be kept: a row (``bucket`` is the time of the run) per column and metric.

    With ``update_ts`` also the seconds from its newest value to the run, as the metric ``lag`` of that column.
    """
    moment = ntz(at)
    kept = [c for c in rows.columns if c != update_ts and not c.startswith(exclude_prefix)]
    metrics = column_anomalies(rows.select(*kept).withColumn("_run", F.expr(moment)), "_run", kept, period="run")
    metrics = metrics.selectExpr("bucket", "column_name", "metric", "value")
    if update_ts is None:
        return metrics
    lag = f"cast({seconds_between(f'max({update_ts})', moment)} AS double)"
    return metrics.unionByName(rows.selectExpr(f"{moment} AS bucket", f"'{update_ts}' AS column_name", "'lag' AS metric", f"{lag} AS value"))


def run_anomalies(history: DataFrame) -> DataFrame:
    """The newest run's metrics against those of the runs before it; reads a row per run and metric."""
    newest = history.agg(F.max("bucket")).scalar()
    return score(history, by=["column_name", "metric"]).filter(F.col("bucket") == newest)
