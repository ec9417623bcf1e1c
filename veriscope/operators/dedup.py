"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order, such as ``"t DESC NULLS LAST"``.

    NULL keys form one group.  Spark turns the row-number filter into a limit per key that runs in
    each map task, so a key that holds a large share of all rows sends one row per task into the
    shuffle.
    """
    rank = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return rows.selectExpr("*", f"{rank} AS _rn").filter("_rn = 1").drop("_rn")
