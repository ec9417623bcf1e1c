"""Data-quality checks: declared per model, each yielding the rows or values that fail it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check.  ``expression`` continues a SQL condition on the column, as in ``> 0``."""

    model: str
    column: str
    kind: str  # not_null, unique, accepted_values, expression, relationships
    severity: str = "error"
    values: tuple = ()
    expression: str | None = None
    where: str | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        extra = f"_{self.expression}" if self.expression else f"_{self.parent}" if self.parent else ""
        return f"{self.kind}_{self.model}_{self.column}{extra}"


# Failing rows or values


def failing_not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def failing_unique(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; NULL does not count."""
    known = rows.filter(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def failing_accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the list, with their number; NULL does not count."""
    other = rows.filter(~F.col(column).isin(*values))
    return other.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def failing_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Known child values that the parent lacks, one row per child row."""
    known = child.select(column).filter(F.col(column).isNotNull())
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return known.join(keys, column, "left_anti")


def failing_expression(rows: DataFrame, column: str, expression: str, where: str | None = None) -> DataFrame:
    """Rows for which the condition is false; an unknown result does not fail."""
    considered = rows.filter(where) if where else rows
    return considered.filter(f"not ({column} {expression})")


def failing_city_coordinates(
    rows: DataFrame,
    city: str = "city",
    latitude: str = "latitude",
    longitude: str = "longitude",
    tolerance: float = 0.1,
) -> DataFrame:
    """Cities at more than one position whose positions lie further apart than the tolerance."""
    positions = rows.select(
        F.col(city).alias("city"), F.col(latitude).alias("la"), F.col(longitude).alias("lo")
    ).distinct()
    spread = positions.groupBy("city").agg(
        F.count(F.lit(1)).alias("coord_variations"),
        (F.max("la") - F.min("la")).alias("lat_range"),
        (F.max("lo") - F.min("lo")).alias("lon_range"),
    )
    apart = (F.col("lat_range") > tolerance) | (F.col("lon_range") > tolerance)
    return spread.filter((F.col("coord_variations") > 1) & apart)


def failing_feels_like(
    rows: DataFrame, column: str = "feels_like_celsius", max_difference: float = 15
) -> DataFrame:
    """Rows whose felt temperature is too far from the measured one."""
    return rows.filter(F.abs(F.col(column) - F.col("temperature_celsius")) > max_difference)


# Suites


def _row_condition(check: Check) -> str | None:
    """The condition under which a single row fails, for checks that need one row only."""
    if check.kind == "not_null":
        return f"{check.column} IS NULL"
    if check.kind == "expression":
        failed = f"NOT ({check.column} {check.expression})"
        return f"({check.where}) AND {failed}" if check.where else failed
    return None


def _counted_value(check: Check) -> Column | None:
    """The value whose number of rows decides, NULL where the row does not count, for checks on distinct values."""
    value = F.col(check.column).cast("string")
    if check.kind == "unique":
        return value
    if check.kind == "accepted_values":
        return F.when(~F.col(check.column).isin(*check.values), value)
    return None


def _result(check: Check, failures: Column) -> Column:
    """One result row of a check from its number of failures."""
    count = failures.cast("bigint")
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        count.alias("failures"),
        F.when(count > 0, "error" if check.severity == "error" else "warn").otherwise("pass").alias("status"),
    )


def _one_model(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of a model that need no other table, in one scan.

    Each row gives a count for the row conditions and one for each value that a check counts; both are added up per check
    and value, in the map tasks first, so that a frequent value is a row per task.  A second aggregate counts, per check, the
    failing rows, the values outside a list, or the values that occur more than once.
    """
    single = [c for c in checks if _row_condition(c)]
    valued = [c for c in checks if _counted_value(c) is not None]
    conditions = [F.expr(_row_condition(c)) for c in single]
    cell = lambda of, value: F.struct(F.lit(of).alias("of"), value.alias("value"))
    cells = [cell(-1, F.lit(None).cast("string")), *(cell(i, _counted_value(c)) for i, c in enumerate(valued))]
    flags = [F.coalesce(x, F.lit(False)).alias(f"f{i}") for i, x in enumerate(conditions)]
    wide = rows.select(*flags, F.filter(F.array(*cells), lambda x: (x.of < 0) | x.value.isNotNull()).alias("cells"))
    long = wide.select(*(f"f{i}" for i in range(len(single))), F.inline("cells"))
    failing = lambda i: F.count_if((F.col("of") < 0) & F.col(f"f{i}")).alias(f"f{i}")
    per_value = long.groupBy("of", "value").agg(F.count(F.lit(1)).alias("n"), *(failing(i) for i in range(len(single))))
    least = lambda check: 1 if check.kind == "accepted_values" else 2
    counts = [F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(single))]
    counts += [F.count_if((F.col("of") == i) & (F.col("n") >= least(c))).alias(f"v{i}") for i, c in enumerate(valued)]
    results = [_result(c, F.col(f"f{i}")) for i, c in enumerate(single)] + [_result(c, F.col(f"v{i}")) for i, c in enumerate(valued)]
    return per_value.agg(*counts).select(F.inline(F.array(*results)))


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: ``(check, model, column, severity, failures, status)``.

    All checks of a model share one scan of it, but for those that look into another model.
    """
    checks = list(checks)
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        own = [c for c in checks if c.model == model]
        if alone := [c for c in own if c.kind in ("not_null", "expression", "unique", "accepted_values")]:
            parts.append(_one_model(models[model], alone))
        for check in own:
            if check.kind == "relationships":
                failing = failing_relationships(models[model], check.column, models[check.parent], check.parent_column)
                parts.append(failing.agg(F.count(F.lit(1)).alias("f")).select(F.inline(F.array(_result(check, F.col("f"))))))
            elif check not in alone:
                raise ValueError(f"unknown kind of check: {check.kind}")
    return reduce(DataFrame.unionByName, parts)
