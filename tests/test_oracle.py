"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from veriscope import bindings

from .conftest import SF_DIR

# The optional queries are tested beside their package.
QUERIES, ORACLES = bindings.QUERIES, bindings.ORACLES


def text(value) -> str:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def table(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    rows = result.collect()
    assert sorted(result.columns) == sorted(expected.columns)
    assert table(result.columns, rows) == table(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", ["pipe_ingest", "stg_current", "dm_forecast_accuracy", "agg_median_two_pass"])
def test_result_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_is_the_accuracy_mart(spark):
    result = entry.entry(spark)
    assert {"provider", "hours_ahead_interval", "temperature_mae"} <= set(result.columns)
    assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_row_types_fit_the_sql(spark, duck):
    """Whole numbers stay whole numbers and times stay times on both sides."""
    for name in ("ods_observations", "dm_city_summary", "stg_current"):
        result = QUERIES[name](spark, SF_DIR)
        expected = dict(zip(duck.sql(ORACLES[name]).columns, map(str, duck.sql(ORACLES[name]).types)))
        for field in result.schema.fields:
            kind = field.dataType.simpleString()
            assert {
                "bigint": expected[field.name] in ("BIGINT", "HUGEINT"),
                "int": expected[field.name] == "INTEGER",
                "double": expected[field.name] == "DOUBLE",
                "string": expected[field.name] == "VARCHAR",
                "timestamp_ntz": expected[field.name] == "TIMESTAMP",
            }[kind], (name, field.name, kind, expected[field.name])
