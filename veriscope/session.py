"""Session settings the library is tested with, and tables written on the way."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "veriscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the clock pinned to UTC.

    Only sizes that hold at any scale are set here.  The number of shuffle partitions is
    left to the cluster's own setting: adaptive execution merges small partitions, so a
    cluster should set it high.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names.

    Only where none is named and the one machine of local mode runs everything, as in tests, a folder is made.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="veriscope-")


_owned: set[str] = set()


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the driver ends."""
    folder = f"{shared_folder(spark)}/veriscope-{spark.sparkContext.applicationId}"
    if folder not in _owned:
        _owned.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder, to be read more than once without being made again."""
    path = f"{own_folder(rows.sparkSession)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.written_to = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Removes tables made by :func:`written` that nothing will read any more."""
    for table in tables:
        _remove(table.sparkSession, table.written_to)
