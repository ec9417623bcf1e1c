"""The append-only store of request documents, and incremental reads from any table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import NTZ, ntz
from ..operators.dedup import latest_per_key
from ..schemas import CITIES, CITY_SCHEMA, ODS_EPOCH, RAW_EPOCH, document_schema

# Partition column of the document store: the day of a document's last change.
INGEST_DAY = "ingest_date"


def read_documents(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Stored documents of one kind, with a declared schema; ``fmt`` is ``parquet`` or ``json``."""
    return spark.read.format(fmt).schema(document_schema(kind)).load(path)


def append_documents(documents: DataFrame, path: str, kind: str) -> None:
    """Adds documents to the store, one folder per day of their last change.

    An incremental read then opens the days since its watermark only.  The rebalancing brings a
    day's documents into few files and splits a day with many.
    """
    columns = document_schema(kind).fieldNames()
    (
        documents.select(*columns, F.coalesce("updated_at", "created_at").cast("date").alias(INGEST_DAY))
        .hint("rebalance", INGEST_DAY)
        .write.mode("append")
        .partitionBy(INGEST_DAY)
        .parquet(path)
    )


def current_documents(documents: DataFrame) -> DataFrame:
    """The present state of every document when its updates were appended as further rows."""
    return latest_per_key(documents, ["_id"], ["updated_at DESC NULLS LAST", "created_at DESC NULLS LAST"])


def read_since(rows: DataFrame, column: str, watermark: dt.datetime | None, inclusive: bool = False) -> DataFrame:
    """Rows changed after the watermark, all rows without one; a literal, so files can be skipped."""
    if watermark is None:
        return rows
    return rows.filter(f"{column} {'>=' if inclusive else '>'} {ntz(watermark)}")


def changed_documents(documents: DataFrame, watermark: dt.datetime) -> DataFrame:
    """Stored documents changed after the watermark; folders of earlier days are not opened."""
    if INGEST_DAY in documents.columns:
        documents = documents.filter(F.col(INGEST_DAY) >= watermark.date())
    return read_since(documents, "updated_at", watermark)


def high_watermark(
    rows: DataFrame,
    column: str,
    lookback: dt.timedelta = dt.timedelta(days=1),
    default: dt.datetime = RAW_EPOCH,
) -> dt.datetime:
    """Newest value of a column less a window to read again; ``default`` for an empty table."""
    newest = rows.agg(F.max(column).cast(NTZ)).first()[0]
    return default if newest is None else newest - lookback


def watermark_rows(rows: DataFrame, column: str, lookback_days: int = 1, default: dt.datetime = RAW_EPOCH) -> DataFrame:
    """:func:`high_watermark` as a one-row table."""
    newest = f"cast(max({column}) AS {NTZ}) - interval {int(lookback_days)} days"
    return rows.selectExpr(f"coalesce({newest}, {ntz(default)}) AS watermark")


def ods_watermark(rows: DataFrame, column: str = "source_changed_at") -> dt.datetime:
    return high_watermark(rows, column, dt.timedelta(0), ODS_EPOCH)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """A city dimension from CSV with a header."""
    return spark.read.csv(path, header=True, schema=CITY_SCHEMA, enforceSchema=False)


def seed_cities(spark: SparkSession) -> DataFrame:
    """The built-in city dimension."""
    return spark.createDataFrame(CITIES, CITY_SCHEMA)
