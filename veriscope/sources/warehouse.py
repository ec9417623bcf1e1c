"""Layered Parquet tables with keyed writes that touch only the days of a batch.

A table is a folder ``<root>/<layer>/<name>`` partitioned by a day.  A keyed write reads the days
its batch falls on, writes their new content to a staging folder once and publishes it by moving the
days' folders.  Staged days are complete, so a publish that was cut short is simply gone on with by
the next write.

Beside a table are kept the newest change stamp written to it and, per day, the newest change stamp
of its rows and the number of the write that touched it last.  An incremental reader turns those into
a filter on the day folders, whatever the table's rows are divided by.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import NTZ, ntz
from ..operators.keyed import delete_insert, require_unique, scd2_changes
from ..schemas import OPEN_END, raw_key, raw_schema
from ..session import written
from .documents import current_documents

PART = "part_day"
# Every finished write leaves a marker; a staged table without one is ignored.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
LAYERS = ["raw", "stg", "ods", "parts", "dm", "quality"]
UNDATED = "__HIVE_DEFAULT_PARTITION__"

Days = Sequence[dt.date | None]  # None: rows without a day


class Day(NamedTuple):
    changed: dt.datetime | None  # newest change stamp of the rows written to it
    write: int  # the last write of its table that touched it


class LoadCounts(NamedTuple):
    inserted: int
    skipped: int


def _on(days: Days) -> Column:
    """Rows of those days; true or false, never unknown, also for rows without a day."""
    dated = [d for d in days if d is not None]
    on = F.coalesce(F.col(PART).isin(dated), F.lit(False)) if dated else F.lit(False)
    return on | F.col(PART).isNull() if None in days else on


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        layer, name = table.split(".")
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{name}"

    def _beside(self, table: str, what: str) -> str:
        """A folder for what belongs to a table but is not a part of it."""
        return f"{self.root}/_{what}/{table}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _there(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _note(self, table: str, what: str, text: str) -> None:
        """A small text kept beside a table.

        It is written whole under another name first; whenever the old one is gone, the new one is complete.
        """
        path = self._beside(table, what)
        fs, fresh = self._fs(f"{path}.new")
        out = fs.create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._move(fs, fresh, self._fs(path)[1])

    def _noted(self, table: str, what: str) -> str | None:
        path = self._beside(table, what)
        for place in (path, f"{path}.new"):
            fs, p = self._fs(place)
            if fs.exists(p):
                stream = fs.open(p)
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                return text
        return None

    def _forget(self, table: str, what: str) -> None:
        for place in (f"{self._beside(table, what)}.new", self._beside(table, what)):
            self._drop(place)

    def exists(self, table: str) -> bool:
        self._finish(table)
        return self._noted(table, "schema") is not None

    def read(self, table: str, from_day: dt.date | None = None, days: Days | None = None) -> DataFrame:
        """A table of an earlier layer as input of a later one; days before ``from_day`` or not in ``days`` are not opened."""
        rows = self._stored(table)
        if from_day is not None:
            rows = rows.filter(F.col(PART).isNull() | (F.col(PART) >= from_day))
        if days is not None:
            rows = rows.filter(_on(days))
        return rows.drop(PART)

    def _stored(self, table: str) -> DataFrame:
        """A table with its day column, if it has one, read with the schema it was made with."""
        return self.spark.read.schema(self._schema(table)).parquet(self.path(table))

    def _schema(self, table: str) -> T.StructType:
        noted = self._noted(table, "schema")
        if noted is None:
            raise ValueError(f"no table {table} in {self.root}")
        return T.StructType.fromJson(json.loads(noted))

    def create(self, table: str, schema: T.StructType, day: str | None = None) -> None:
        """An empty table if there is none."""
        if not self.exists(table):
            self.overwrite(table, self.spark.createDataFrame([], schema), day)

    # Watermarks and the index of days

    def watermark(self, table: str) -> dt.datetime | None:
        """Newest change stamp written to the table, NULL if nothing was."""
        text = self._noted(table, "watermark")
        return dt.datetime.fromisoformat(text) if text else None

    def _advance(self, table: str, newest: dt.datetime | None, reset: bool = False) -> None:
        before = None if reset else self.watermark(table)
        newest = max((m for m in (before, newest) if m is not None), default=None)
        if reset or newest != before:
            self._note(table, "watermark", newest.isoformat() if newest else "")

    def index(self, table: str) -> dict[dt.date | None, Day]:
        """Every day that was written to; grows with the calendar only."""
        noted = json.loads(self._noted(table, "days") or "{}")
        moment = lambda x: dt.datetime.fromisoformat(x) if x else None
        return {dt.date.fromisoformat(d) if d else None: Day(moment(c), w) for d, (c, w) in noted.items()}

    def changed_since(self, table: str, since: dt.datetime | None) -> list[dt.date | None] | None:
        """Days that may hold rows changed at ``since`` or later; None without it: all."""
        if since is None:
            return None
        return [d for d, day in self.index(table).items() if day.changed is not None and day.changed >= since]

    def touched_since(self, table: str, write: int) -> list[dt.date | None]:
        """Days touched by a later write than the one of that number."""
        return [d for d, day in self.index(table).items() if day.write > write]

    def last_write(self, table: str) -> int:
        return max((day.write for day in self.index(table).values()), default=0)

    def made_of(self, table: str) -> dict[str, int]:
        """For a table made of others, up to which of their writes; empty if not known."""
        return json.loads(self._noted(table, "made_of") or "{}")

    def note_made_of(self, table: str, writes: dict[str, int]) -> None:
        self._note(table, "made_of", json.dumps(writes))

    def _touch(self, table: str, found: dict[dt.date | None, dt.datetime | None], reset: bool = False) -> None:
        """Notes days before they are published: an index that is ahead makes a reader open a day too many, never miss one.

        Numbers of writes go on after a rebuild, so that who has read up to one of them sees the rebuilt days.
        """
        before = self.index(table)
        after = {} if reset else dict(before)
        write = 1 + max((day.write for day in before.values()), default=0)
        for d, stamp in found.items():
            stamps = [s for s in (stamp, after[d].changed if d in after else None) if s is not None]
            after[d] = Day(max(stamps, default=None), write)
        if reset:  # days that are gone count as touched
            after |= {d: Day(None, write) for d in before if d not in after}
        noted = {d.isoformat() if d else "": [x.changed.isoformat() if x.changed else None, x.write] for d, x in after.items()}
        self._note(table, "days", json.dumps(noted))

    # Writes

    def _partitioned(self, rows: DataFrame, day: str | None) -> DataFrame:
        return rows.withColumn(PART, F.col(day).cast("date")) if day else rows

    def _writer(self, rows: DataFrame, mode: str, order: Sequence[str] = (), **options: str) -> DataFrameWriter:
        """Rows of a day go to few files: days are brought together, and large ones are split.

        ``order`` sorts the rows inside each file, so that a reader of a range skips most of it.
        """
        if PART not in rows.columns:
            return rows.write.mode(mode).options(**MARKED, **options)
        rows = rows.hint("rebalance", PART)
        if order:
            rows = rows.sortWithinPartitions(PART, *order)
        return rows.write.mode(mode).options(**MARKED, **options).partitionBy(PART)

    def _stamps(
        self, rows: DataFrame, changed: str | None, stamp: str | None = None
    ) -> tuple[dict[dt.date | None, dt.datetime | None], dt.datetime | None]:
        """The days some rows fall on with the newest change stamp of each, and the newest ``stamp`` of all, in one job.

        What reaches the driver grows with the calendar only.
        """
        newest = lambda x: F.max(F.expr(x).cast(NTZ)) if x else F.lit(None).cast(NTZ)
        if PART not in rows.columns:
            return {}, rows.agg(newest(stamp)).first()[0] if stamp else None
        found = rows.groupBy(PART).agg(newest(changed or stamp), newest(stamp)).collect()
        return {r[0]: r[1] for r in found}, max((r[2] for r in found if r[2]), default=None)

    def _days_of(self, rows: DataFrame) -> list[dt.date | None]:
        return list(self._stamps(rows, None)[0])

    def overwrite(
        self,
        table: str,
        rows: DataFrame,
        day: str | None = None,
        stamp: str | None = None,
        changed: str | None = None,
        order: Sequence[str] = (),
    ) -> None:
        """Rebuilds a table, whatever it held.  ``rows`` must not read the table itself.

        ``stamp`` is the column of the table's watermark, ``changed`` the expression by which later layers ask what is new
        (``stamp`` if not given).
        """
        self._drop(self._beside(table, "staging"))
        # Without its schema a table does not count as there, so a rebuild cut short is begun again.
        self._forget(table, "schema")
        rows = self._partitioned(rows, day)
        self._writer(rows, "overwrite", order, partitionOverwriteMode="static").parquet(self.path(table))
        found, newest = self._stamps(self.spark.read.schema(rows.schema).parquet(self.path(table)), changed, stamp)
        if day:
            self._touch(table, found, reset=True)
        self._note(table, "schema", rows.schema.json())
        self._advance(table, newest, reset=True)

    def append(self, table: str, rows: DataFrame) -> None:
        """Adds rows to an undivided table, which is made if there is none; for what is kept of every run."""
        self.create(table, rows.schema)
        rows.write.mode("append").options(**MARKED).parquet(self.path(table))

    def recover(self, tables: Sequence[str]) -> None:
        """Finishes what interrupted writes left behind; for the one job that writes, not for readers."""
        for table in tables:
            self._finish(table)

    def _finish(self, table: str) -> None:
        if self._there(f"{self._beside(table, 'staging')}/_SUCCESS"):
            self._publish(table)

    def _staged(self, table: str) -> DataFrame:
        return self.spark.read.schema(self._schema(table)).parquet(self._beside(table, "staging"))

    def _publish(self, table: str) -> None:
        """Moves what is staged to its place: day by day, or the whole of an undivided table.

        What has been moved is no longer staged, so after an interruption only the rest is moved.
        """
        fs, staging = self._fs(self._beside(table, "staging"))
        _, target = self._fs(self.path(table))
        if PART in self._schema(table).fieldNames():
            fs.mkdirs(target)
            for day in [f.getPath() for f in fs.listStatus(staging) if f.isDirectory()]:
                self._move(fs, day, self.spark._jvm.org.apache.hadoop.fs.Path(target, day.getName()))
            fs.delete(staging, True)
        else:
            self._move(fs, staging, target)

    def _move(self, fs, source, target) -> None:
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")

    def _replace(
        self, table: str, rows: DataFrame, stamp: str | None, changed: str | None = None, order: Sequence[str] = ()
    ) -> Days:
        """Replaces the days of some rows, or an undivided table, by way of the staging folder; which days."""
        self._writer(rows, "overwrite", order).parquet(self._beside(table, "staging"))
        found, newest = self._stamps(self._staged(table), changed, stamp)
        if found:
            self._touch(table, found)
        self._publish(table)
        self._advance(table, newest)
        return list(found)

    def replace(self, table: str, rows: DataFrame, unique: Sequence[str] = ()) -> None:
        """Replaces an undivided table as a whole; with ``unique``, a key repeated in the rows is an error."""
        if unique:
            rows = written(rows)
            require_unique(rows, unique)
        if self.exists(table):
            self._replace(table, rows, None)
        else:
            self.overwrite(table, rows)

    def replace_days(
        self, table: str, rows: DataFrame, day: str, days: Days, order: Sequence[str] = (), stamp: str | None = None
    ) -> None:
        """Those days become what ``rows`` has of them, perhaps nothing; days of ``rows`` beyond them are replaced too."""
        for d in set(days) - set(self._replace(table, self._partitioned(rows, day), stamp, order=order)):
            self._drop(f"{self.path(table)}/{PART}={d or UNDATED}")

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        day: str | None = None,
        stamp: str | None = None,
        unique: bool = False,
        changed: str | None = None,
    ) -> None:
        """Replaces the rows of the batch's keys.  ``day`` is a column of the key, so a key has one day.

        With ``unique`` a key repeated in the batch is an error.  Without ``day`` the whole table is
        rewritten: for marts, whose size is that of their groups.
        """
        if day and day not in keys:
            raise ValueError(f"{day} must be a part of the key")
        if not self.exists(table) and not unique:
            self.overwrite(table, batch, day, stamp, changed)
            return
        # The batch's model is run once; all steps below read its result.
        batch_path = self._beside(table, "batch")
        batch = self._partitioned(batch, day)
        self._writer(batch, "overwrite").parquet(batch_path)
        batch = self.spark.read.schema(batch.schema).parquet(batch_path)
        if unique:
            require_unique(batch, keys)
        if not self.exists(table):
            self.overwrite(table, batch.drop(PART), day, stamp, changed)
        elif not day:
            # A mart holds one row per group, also for the group without a key.
            self._replace(table, delete_insert(self._stored(table), batch, keys, null_safe=True), stamp)
        else:
            days = self._days_of(batch)
            if days:
                target = self._stored(table).filter(_on(days))
                self._replace(table, delete_insert(target, batch, keys), stamp, changed)
        self._drop(batch_path)

    def scd2_load(self, kind: str, documents: DataFrame, now: dt.datetime, forward: bool = False) -> LoadCounts:
        """Loads documents into a raw table: see :func:`veriscope.operators.keyed.scd2_upsert`.

        With ``forward`` a version older than the one in force is skipped, so that the order of arrival does not matter.

        Returns how many documents opened a version and how many were skipped.  The watermark advances
        once, after all writes, so a load that was cut short is simply run again.

        Of several states of a document the latest counts.  The table is partitioned by a
        document's day of creation, which never changes.  New documents are appended.  Only days
        with a changed document are rewritten.  Ids are digests of key and version, so that a task
        which runs twice writes the same id.
        """
        table, key, change = f"raw.weather_{kind}", raw_key(kind), "updated_at"
        columns = raw_schema(kind).fieldNames()
        self.create_raw(kind)
        days = self._days_of(documents.select(F.col("created_at").cast("date").alias(PART)))
        if not days:
            return LoadCounts(0, 0)
        version = F.concat_ws("|", F.col(key), F.coalesce(F.col(change).cast("string"), F.lit("")))
        rows = (
            current_documents(documents)
            .withColumnRenamed("_id", key)
            .withColumn("id", F.md5(version))
            .select(*[c for c in columns if not c.startswith("valid_")], F.col("created_at").cast("date").alias(PART))
        )
        target = self._stored(table).filter(_on(days))
        in_force = F.expr(f"valid_to_dttm = {ntz(OPEN_END)}")
        # What is new is found once and written; the steps below read that.
        opened_path = self._beside(table, "opened")
        scd2_changes(target.filter(in_force), rows, key, change, one_each=True, forward=forward).write.mode("overwrite").parquet(
            opened_path
        )
        opened = (
            self.spark.read.parquet(opened_path)
            .withColumn("valid_from_dttm", F.expr(ntz(now)))
            .withColumn("valid_to_dttm", F.expr(ntz(OPEN_END)))
        )
        changed = opened.filter("_replaces")
        changed_days = self._days_of(changed)
        rewritten = _on(changed_days)
        if changed_days:
            closing = changed.select(key, F.lit(True).alias("_closed"))
            until = F.when(F.col("_closed") & in_force, F.expr(ntz(now))).otherwise(F.col("valid_to_dttm"))
            before = target.filter(rewritten).join(closing, key, "left").withColumn("valid_to_dttm", until)
            after = opened.filter(rewritten)
            self._replace(table, before.select(*columns, PART).unionByName(after.select(*columns, PART)), None, change)
        appended = opened.filter(~rewritten).select(*columns, PART)
        if found := self._stamps(appended, change)[0]:
            self._touch(table, found)
            self._writer(appended, "append").parquet(self.path(table))
        # One document per id was given; only two columns are read for this.
        given = documents.groupBy("_id").agg(F.max(F.col(change).cast(NTZ)).alias("newest"))
        n, newest = given.agg(F.count(F.lit(1)), F.max("newest")).first()
        self._advance(table, newest)
        inserted = opened.count()
        return LoadCounts(inserted, n - inserted)

    def create_raw(self, kind: str) -> None:
        self.create(f"raw.weather_{kind}", raw_schema(kind), "created_at")
