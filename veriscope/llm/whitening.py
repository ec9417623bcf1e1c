"""Whitening of embeddings with distributed block matrices.

A vector's entries become exact whole numbers.  Each distinct vector counts once for the statistics (the fit list): its
per-dimension sums are exact, its rows are centred by exact differences, numbered without gaps and laid into row blocks
of a ``BlockMatrix``; transpose times matrix, in splits along the rows, gives the scatter.  Only that square matrix, as
wide as a vector, reaches the driver, which takes its eigenvectors.  All rows, numbered and centred likewise, are
multiplied by the whitening matrix and joined back by their numbers, which are unique, so no vector is a hot key.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.session import written

STEP = 64  # parts of one, to which entries are cut
SHIFT = 1_000_000  # makes them positive
COMPONENTS = 16
BLOCK_VALUES = 1 << 16  # entries of a block
SPLIT_BLOCKS = 16  # row blocks that one task of a transpose-multiplication holds
FLAT = 1e-12  # an eigenvalue of at most this share of the trace is no direction of the data

EXACT = "decimal(38,0)"


def whole(vector: Column) -> Column:
    """A vector's entries as long numbers; NULL for a vector that is NULL, empty or holds a NULL or non-finite entry."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    cut = F.transform(vector, lambda c: F.floor(c.cast("double") * STEP) + SHIFT)
    return F.when((F.size(vector) > 0) & ~bad, cut)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows, written, with ``_index`` from 0 on without gaps."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = written(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", within))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per task of that write
    parts = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    first = written(parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    return kept.join(first, "_part").withColumn("_index", F.col("_first") + F.col("_row")).drop("_part", "_row", "_first")


def blocks(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """``_index, _values`` (numbered rows of doubles) as a matrix of row blocks."""
    vectors = rows.select("_index", array_to_vector("_values").alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    matrix = IndexedRowMatrix(vectors, n, width).toBlockMatrix(max(1, BLOCK_VALUES // width), width)
    # A product asks for the blocks' places first; kept blocks are not put together again, lost ones are.
    return matrix.persist(StorageLevel.MEMORY_AND_DISK)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix.

    The product is one block; splits let many tasks add up their row blocks first.  The JVM's ``multiply`` takes their
    number, Python's wrapper does not pass one.
    """
    turned = matrix.transpose()
    splits = -(-matrix.numRows() // (matrix.rowsPerBlock * SPLIT_BLOCKS))
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def multiplied(matrix: BlockMatrix, by: np.ndarray) -> DataFrame:
    """``_index, _values``: the matrix's rows times a small local matrix.

    The product's blocks are as wide as that matrix, so a block's rows are read from it in place (it is stored by column).
    """
    width, k = by.shape
    block = ((0, 0), Matrices.dense(width, k, by.flatten(order="F").tolist()))
    right = BlockMatrix(matrix.blocks.context.parallelize([block], 1), width, k)
    product = matrix.multiply(right)
    found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).toDF("_at", "_matrix")
    found = found.select(F.col("_at._1").cast("long").alias("_block"), F.unwrap_udt("_matrix").alias("_m"))
    each = found.select("_block", "_m", F.explode(F.sequence(F.lit(0), F.col("_m.numRows") - 1)).alias("_row"))
    values = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: F.get("_m.values", c * F.col("_m.numRows") + F.col("_row")))
    return each.select((F.col("_block") * matrix.rowsPerBlock + F.col("_row")).alias("_index"), values.alias("_values"))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row per vector and component (the first ``most`` at most) with its whitened coordinate.

    ``key, component, n, deviation, whitened, explained, identity_error``.  Rows whose vector is NULL, empty or holds a NULL
    or non-finite entry are left out, and so are vectors of another length than most vectors have (on a tie, the longer).
    Keys may be NULL or repeated: every row counts for itself.  A component along which the data do not vary (equal
    vectors, fewer vectors than components) has ``whitened`` NULL and does not count in ``identity_error``, which is 0 if
    there is none that varies.  ``deviation`` is NULL if it is too large for a long.  No rows give no rows.
    """
    spark = rows.sparkSession
    given = rows.select(F.col(key).alias("_key"), whole(F.col(vector)).alias("_x")).filter("_x IS NOT NULL")
    given = written(given)
    lengths = given.groupBy(F.size("_x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, "
    schema += "explained double, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    width = lengths.size
    given = given.filter(F.size("_x") == width)

    fit = written(given.select("_x").distinct())
    sums = fit.select(F.posexplode("_x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    found = {r.i: r for r in sums.collect()}  # a row per dimension
    n = found[0].n
    total = F.array(*(F.lit(found[i].s) for i in range(width)))
    away = F.zip_with("_x", total, lambda x, s: x * n - s)  # n times the centred entry, exact
    centred = F.transform("_away", lambda d: d / n)

    def matrix(table: DataFrame, count: int) -> BlockMatrix:
        return blocks(table.select("_index", centred.alias("_values")), count, width)

    lists = matrix(numbered(fit.select(away.alias("_away"))), n)
    covariance = scatter(lists) / n
    spread, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-spread, kind="stable")[: min(most, width)]
    trace = float(np.trace(covariance))
    spread, directions = spread[order], directions[:, order]
    varies = spread > FLAT * trace
    directions = directions * np.where(np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(order))]) < 0, -1.0, 1.0)
    by = directions / np.sqrt(np.where(varies, spread, np.inf))

    error = 0.0
    if varies.any():
        own = written(multiplied(lists, by[:, varies]))
        k = int(varies.sum())
        means = own.select(*(F.avg(F.get("_values", F.lit(i))) for i in range(k))).first()
        level = F.array(*(F.lit(float(m)) for m in means))
        rest = own.select("_index", F.zip_with("_values", level, lambda v, m: v - m).alias("_values"))
        error = float(np.abs(scatter(blocks(rest, n, k)) / n - np.eye(k)).max())

    square = F.aggregate(
        "_away",
        F.lit(0).cast(EXACT),
        lambda a, d: (a + (d.cast("decimal(19,0)") * d.cast("decimal(19,0)")).cast(EXACT)).cast(EXACT),
    )
    every = written(numbered(given.select("_key", away.alias("_away"))).withColumn("_square", square.try_cast("long")))
    placed = multiplied(matrix(every, every.count()), by)
    shares = F.array(*(F.lit(float(e) / trace if trace > 0 else 0.0) for e in np.maximum(spread, 0.0)))
    real = F.array(*(F.lit(bool(v)) for v in varies))
    each = every.join(placed, "_index").select("_key", "_square", F.posexplode("_values").alias("_c", "_w"))
    return each.select(
        F.col("_key").alias(key),
        (F.col("_c") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.col("_square").alias("deviation"),
        F.when(F.get(real, "_c"), F.col("_w")).alias("whitened"),
        F.get(shares, "_c").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
