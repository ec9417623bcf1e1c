"""Mixing sources to target weights by balanced sampling (the cube method).

A source's target says how often its documents are taken on average, between 0 and ``MOST`` times.  The whole part of that
is taken of every document; the rest is an inclusion probability, fractional and equal within the source.  The flight phase
moves the probabilities of three documents at a time along the one direction that changes neither their sum (documents) nor
their sum of sizes (tokens), one way or the other at random so that each keeps its mean, until one of them is 0 or 1; it goes
on with the next document in its place.  So all but two documents of any group are settled with both totals kept.

Groups of at most about ``GROUP`` documents of one source fly in parallel; what they leave (``LEFT`` each, of which all but two
did not fly) is merged into groups of the next level, until a source has one group.  There a landing problem of at most
``LANDING`` documents remains, whose combinations are all looked at: the one nearest to both totals is taken.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all sizes
MOST = 2  # times that a document is taken
GROUP = 1024
LEFT = 6  # documents that a group leaves to the next level
LANDING = 14  # documents, 2^14 combinations
DOCUMENT = 0.01  # mean sizes that one document too many or too few counts as
SEED = 20211
NEAR = 1e-9  # of 0 or 1


def size_of(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, rank, docs, source_size, target`` from ``source, size``; a row per source.

    ``share`` of all sizes is dealt by weight; sources by code point (NULL last) have the weights in turn.  A target stops
    at ``most`` times its source's size.  The level ``total / weight`` at which dealing the excess again ends is found at
    once: sources that stop are those with the least size per weight.  Windows go over one row per source.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("rank", F.lit(len(weights))))
    ranked = own.withColumn("rank", rank).withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(most))
    by_need = Window.orderBy(F.col("_cap") / F.col("_weight"), "rank")
    above = by_need.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # The level if just the sources before this one have stopped; it is right at the first one that does not stop then.
    left = F.sum("source_size").over(every) * share - F.coalesce(F.sum("_cap").over(above), F.lit(0.0))
    level = left / (F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(above), F.lit(0.0)))
    found = ranked.withColumn("_level", level)
    whole = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level")), ignorenulls=True).over(whole)
    # None: all stop, which only happens if ``share`` is ``most`` or more.
    target = F.coalesce(F.least(first * F.col("_weight"), "_cap"), F.col("_cap"))
    return found.select("source", "rank", "docs", "source_size", target.alias("target"))


def flown(sizes: list[float], chance: list[float], draw: random.Random, free: list[int]) -> list[int]:
    """Settles ``chance`` in place for all but two of the documents ``free``; gives those back.

    The direction of three documents is the cross product of (1, 1, 1) and their sizes.
    """
    waiting = iter(free)
    active: list[int] = []
    while True:
        while len(active) < 3:
            i = next(waiting, None)
            if i is None:
                return active
            active.append(i)
        i, j, k = active
        a, b, c = sizes[i], sizes[j], sizes[k]
        steps = (c - b, a - c, b - a) if a != b or b != c else (1.0, -1.0, 0.0)
        up = down = float("inf")
        for x, v in zip(active, steps, strict=True):
            if v > 0:
                up, down = min(up, (1 - chance[x]) / v), min(down, chance[x] / v)
            elif v < 0:
                up, down = min(up, chance[x] / -v), min(down, (1 - chance[x]) / -v)
        step = up if draw.random() * (up + down) < down else -down
        for x, v in zip(active, steps, strict=True):
            moved = chance[x] + step * v
            chance[x] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved
        active = [x for x in active if 0 < chance[x] < 1]


def landed(sizes: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """0 or 1 for each of a few documents: of all combinations the one nearest to the expected tokens and documents.

    Errors in tokens count in mean sizes, and decide but for small differences.
    """
    n = len(sizes)
    takes = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(float)
    mean = max(1.0, float(sizes.mean()))
    cost = np.abs(takes @ sizes - chance @ sizes) / mean + DOCUMENT * np.abs(takes.sum(axis=1) - chance.sum())
    return takes[int(cost.argmin())]


def settled(rows: pd.DataFrame, level: int) -> pd.DataFrame:
    """One group's documents with ``chance`` 0 or 1 for all but ``LEFT``, or for all if it is its source's only group.

    The order depends on the rows' contents alone: by size, from large to small, so that the small ones even out what the large
    ones leave.  Documents of evenly spread sizes are kept from the flight for what comes after it.
    """
    rows = rows.sort_values(["size", "key", "chance"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    first = rows.iloc[0]
    draw = random.Random(f"{SEED} {level} {first['rank']} {first['group']}")
    sizes, chance = rows["size"].astype(float).tolist(), rows["chance"].tolist()
    free = [i for i, p in enumerate(chance) if 0 < p < 1]
    last = int(first["groups"]) == 1
    spread = np.linspace(0, len(free) - 1, min(len(free), (LANDING if last else LEFT) - 2)) if free else []
    kept = sorted({free[int(p)] for p in spread})
    left = flown(sizes, chance, draw, [i for i in free if i not in set(kept)])
    if last and (rest := sorted([*left, *kept])):
        for i, take in zip(rest, landed(np.array([sizes[i] for i in rest]), np.array([chance[i] for i in rest])), strict=True):
            chance[i] = float(take)
    return rows.assign(chance=chance)


def flight(level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return settled(rows, level)

    return run


def balanced(units: DataFrame) -> DataFrame:
    """``rank, key, size, chance`` (and other columns) with every ``chance`` moved to 0 or 1.

    ``units`` also has ``docs``, how many there are of its rank.  ``key`` (a long) orders and deals the rows: rows with one key
    are in one group.  Level by level, each a written table; three levels do for 10^7 rows of a rank.
    """
    schema = units.withColumns({"groups": F.lit(1).cast("long"), "group": F.lit(1).cast("long")}).schema
    groups = F.ceil(F.col("docs") / GROUP).cast("long")
    left = units.withColumn("groups", groups).withColumn("group", F.pmod(F.xxhash64("key"), "groups"))
    level, done = 0, []
    while True:
        sure = left.filter("chance = 0 OR chance = 1")
        fractional = left.filter("chance > 0 AND chance < 1")
        flew = written(fractional.groupBy("rank", "group").applyInPandas(flight(level), schema))
        done += [sure, flew.filter("chance = 0 OR chance = 1")]
        left = flew.filter("chance > 0 AND chance < 1")
        if left.isEmpty():
            break
        merged = GROUP // LEFT  # groups make one of the next level
        left = left.withColumn("group", F.floor(F.col("group") / merged)).withColumn("groups", F.ceil(F.col("groups") / merged))
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.drop("groups", "group")


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id"
) -> DataFrame:
    """``key, source, size, source_size, target, copies, taken``: how often a mixture takes each document.

    A NULL source is a source.  A source without any word has target 0 and gives nothing; a document without words is taken
    0 to ``most`` times like others and adds no word.  Every row counts for itself; equal rows may swap what they get.  Reruns
    agree: draws and orders depend on the rows' contents alone.
    """
    rows = docs.select(F.col(key).alias("_doc"), "source", size_of(F.col("text")).alias("size"))
    rows = written(rows)
    sources = written(targets(rows, weights, share, most))
    met = rows.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = met.withColumn("_times", times).select(
        "_doc",
        "source",
        "rank",
        "docs",
        "size",
        "source_size",
        "target",
        F.xxhash64("_doc", "size").alias("key"),
        F.floor("_times").alias("_whole"),
        (F.col("_times") - F.floor("_times")).alias("chance"),
    )
    copies = (F.col("_whole") + F.col("chance")).cast("long")
    result = balanced(units).withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return result.select(F.col("_doc").alias(key), "source", "size", "source_size", "target", "copies", "taken")
