"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The sketch that brackets a median errs by at most 1 / SKETCH_ACCURACY of the group's rows.
SKETCH_ACCURACY = 100_000


def grouped_median(
    rows: DataFrame, keys: Sequence[str], value: str, name: str, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Exact median per group without holding a group in one task.

    A mergeable sketch brackets the median of every group; its rank error is bounded, so the exact
    middle values lie inside the bracket.  A second pass counts what lies below the bracket and
    ranks only the distinct values inside it, a few in a hundred thousand of the group; it fails if
    the middle is not inside.  ``rows`` is read twice, so a caller with a costly plan should write it
    to a table first.  The brackets are one row per group, and Spark decides how they are joined.
    """
    known = rows.select(*keys, value).filter(F.col(value).isNotNull())
    # Three times the guaranteed rank error on either side of the middle.
    margin = 3.0 / accuracy
    fine = F.col("_n") < accuracy  # a rank error of 1 / accuracy is less than one row here
    brackets = (
        known.groupBy(*keys)
        .agg(
            F.percentile_approx(value, [0.5 - margin, 0.5 + margin], accuracy).alias("_q"),
            F.min(value).alias("_min"),
            F.max(value).alias("_max"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.when(fine, F.col("_min")).otherwise(F.col("_q")[0]).alias("_lo"),
            F.when(fine, F.col("_max")).otherwise(F.col("_q")[1]).alias("_hi"),
            F.floor((F.col("_n") - 1) / 2).alias("_rank_lo"),
            F.ceil((F.col("_n") - 1) / 2).alias("_rank_hi"),
        )
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))

    # One count per distinct value inside the bracket and one (NULL) for everything below it.
    counted = (
        known.join(brackets, same)
        .filter(F.col(value) <= F.col("_hi"))
        .groupBy(*keys, "_rank_lo", "_rank_hi", F.when(F.col(value) >= F.col("_lo"), F.col(value)).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("_end", F.sum("_c").over(upto))
    hit = lambda rank: F.min(F.when(F.col("_v").isNotNull() & (F.col("_end") > F.col(rank)), F.col("_v")))
    # The counts prove that both middle ranks lie inside the bracket.
    below = F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_c"))), F.lit(0))
    inside = (below <= F.first("_rank_lo")) & (F.max("_end") > F.first("_rank_hi"))
    middle = hit("_rank_lo") * F.lit(0.5) + hit("_rank_hi") * F.lit(0.5)
    missed = F.raise_error(F.lit("the sketch of a median missed its middle")).cast("double")
    return ranked.groupBy(*keys).agg(F.when(inside, middle).otherwise(missed).alias(name))
