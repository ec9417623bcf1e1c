"""Documents from a growing folder into the raw tables, as a stream that stops when caught up."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..plans.jobs import build_arrived, utc_now
from ..schemas import document_schema
from ..sources.warehouse import Warehouse


def stream_ingest(
    warehouse: Warehouse,
    kind: str,
    source: str,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    clock: Callable[[], dt.datetime] = utc_now,
    cities: DataFrame | None = None,
):
    """Starts the stream; ``checkpoint`` remembers the files already loaded.

    A batch that runs again after a failure changes nothing, because documents whose version is
    in force already are skipped.

    With ``cities`` each batch goes on through staging to the operational table of its kind.  What is
    carried from batch to batch is in the tables: the version in force of each document, and per table
    which write of the one before it has been read.  Versions older than the one in force are skipped
    and days are made again as a whole, so files may arrive in any order; a batch cut short between two
    tables is gone on with by the next one.
    """
    reader = warehouse.spark.readStream.format(fmt).schema(document_schema(kind))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, _: int) -> None:
        warehouse.scd2_load(kind, batch, clock(), forward=cities is not None)
        if cities is not None:
            build_arrived(warehouse, cities, kind)

    return (
        reader.load(source)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
