"""Keyed writes as DataFrame operators: what a target holds after a batch was applied to it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import hour_of, ntz
from ..schemas import OPEN_END
from .dedup import latest_per_key


class DuplicateKeyError(ValueError):
    """A batch to be merged holds a key more than once."""


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, NULL equal to NULL."""
    return reduce(and_, (left[k].eqNullSafe(right[k]) for k in keys))


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Target rows whose key is in the batch go, all batch rows come.

    A key with a NULL matches none, unless ``null_safe``.
    """
    stale = batch.select(*keys).distinct()
    on = _same(target, stale.alias("_stale"), keys) if null_safe else list(keys)
    return target.join(stale, on, "left_anti").select(*batch.columns).unionByName(batch)


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Matched target rows are replaced, new keys inserted, keys absent from the batch kept.

    ``check`` runs a job over the batch that fails on a repeated key.  Leave it out only for
    batches that are unique by construction, such as a grouping by the same keys.
    """
    if check:
        require_unique(batch, keys)
    return delete_insert(target, batch, keys)


def require_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    known = batch
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    twice = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    if twice:
        raise DuplicateKeyError(f"key {twice[0].asDict()} is in the batch more than once")


def next_in_time(rows: DataFrame, key: str, time: str, name: str) -> DataFrame:
    """The next later ``time`` of the same key, NULL for the last.

    A window over a key alone would put a key with a third of all rows into one task.  Rows are
    ranked within (key, hour) instead; the last row of an hour takes the first time of the key's
    next non-empty hour, from a table with one row per key and hour.  ``time`` must not repeat
    within a key.  A NULL key is a key like others; a row without ``time`` is kept and has no next.
    """
    by_hour = rows.selectExpr("*", f"{hour_of(time)} AS _hour")
    in_hour = Window.partitionBy(key, "_hour").orderBy(time)
    hours = by_hour.groupBy(key, "_hour").agg(F.min(time).alias("_first"))
    hours = hours.select(
        F.col(key).alias("_key"),
        F.col("_hour").alias("_of"),
        F.lead("_first").over(Window.partitionBy(key).orderBy("_hour")).alias("_next_first"),
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_hour").eqNullSafe(F.col("_of"))
    return (
        by_hour.withColumn("_next", F.lead(time).over(in_hour))
        .join(hours, same)
        .withColumn(name, F.when(F.col(time).isNotNull(), F.coalesce("_next", "_next_first")))
        .drop("_hour", "_next", "_next_first", "_key", "_of")
    )


def one_of_each_version(log: DataFrame, key: str, change: str) -> DataFrame:
    """One row per key and stamp; of several the one with the largest text counts, so a rerun keeps the same."""
    return latest_per_key(log, [key, change], ["to_json(struct(*)) DESC"])


def scd2_history(log: DataFrame, key: str, change: str) -> DataFrame:
    """Every version in a change log with its span of validity, from one change to the next."""
    versions = next_in_time(one_of_each_version(log, key, change), key, change, "_until")
    return versions.select(
        *log.columns,
        F.col(change).alias("valid_from_dttm"),
        F.coalesce("_until", F.expr(ntz(OPEN_END))).alias("valid_to_dttm"),
    )


def scd2_changes(
    active: DataFrame, batch: DataFrame, key: str, change: str, one_each: bool = False, forward: bool = False
) -> DataFrame:
    """Batch rows that open a new version, with ``_replaces`` (key was active) and ``_is_newest``.

    A key whose newest batch version carries the active version's change stamp is unchanged, so
    replaying a batch does nothing.  Otherwise the versions later than the active one are new; a
    newest version older than the active one still replaces it, unless ``forward``.  ``one_each`` says
    that the batch holds one version per key, which takes a single join.
    """
    standing = active.select(key, F.col(change).alias("_active"), F.lit(True).alias("_known"))
    if one_each:
        rows = batch.join(standing, key, "left")
        is_newest = F.lit(True)
        wanted = F.col("_known").isNull() | ~F.col(change).eqNullSafe(F.col("_active"))
        if forward:
            wanted = wanted & ~F.coalesce(F.col(change) < F.col("_active"), F.lit(False))
    else:
        newest = batch.groupBy(key).agg(F.max(change).alias("_newest"))
        rows = one_of_each_version(batch, key, change).join(newest.join(standing, key, "left"), key)
        is_newest = F.col(change).eqNullSafe(F.col("_newest"))
        later = F.coalesce(F.col(change) > F.col("_active"), F.lit(False)) | (
            F.col("_active").isNull() & F.col(change).isNotNull()
        )
        unchanged = F.col("_newest").eqNullSafe(F.col("_active"))
        wanted = F.col("_known").isNull() | (~unchanged & (is_newest | later))
    return rows.filter(wanted).select(
        *batch.columns, F.col("_known").isNotNull().alias("_replaces"), is_newest.alias("_is_newest")
    )


def scd2_upsert(
    target: DataFrame, batch: DataFrame, key: str, change: str, now: dt.datetime
) -> DataFrame:
    """All versions after a batch: changed active versions end at ``now``, new ones start there.

    ``batch`` has the columns of ``target`` but for the span of validity.  Of several new versions
    of one key only the newest stays in force; the others start and end at ``now``.
    """
    moment = F.expr(ntz(now))
    in_force = F.expr(f"valid_to_dttm = {ntz(OPEN_END)}")
    opened = scd2_changes(target.filter(in_force), batch, key, change)
    replaced = opened.filter("_replaces").select(key, F.lit(True).alias("_closed")).distinct()
    before = (
        target.join(replaced, key, "left")
        .withColumn(
            "valid_to_dttm",
            F.when(F.col("_closed") & in_force, moment).otherwise(F.col("valid_to_dttm")),
        )
        .select(*target.columns)
    )
    after = opened.select(
        *batch.columns,
        moment.alias("valid_from_dttm"),
        F.when(F.col("_is_newest"), F.expr(ntz(OPEN_END))).otherwise(moment).alias("valid_to_dttm"),
    ).select(*target.columns)
    return before.unionByName(after)


def scd2_counts(target: DataFrame, batch: DataFrame, key: str, change: str) -> DataFrame:
    """How many batch rows a load inserts and how many it skips."""
    in_force = target.filter(f"valid_to_dttm = {ntz(OPEN_END)}")
    opened = scd2_changes(in_force, batch, key, change).select(F.lit(1).alias("opened"), F.lit(0).alias("given"))
    both = opened.unionAll(batch.select(F.lit(0), F.lit(1)))
    inserted, given = (F.coalesce(F.sum(c), F.lit(0)) for c in ("opened", "given"))
    return both.agg(inserted.alias("inserted"), (given - inserted).alias("skipped"))
