"""Whitening of embeddings with MLlib's BlockMatrix.

Entries become whole numbers x. The fit list has each distinct x vector once. Its rows, less their mean,
are indexed and cut into blocks; the product of the transposed block matrix with itself is the scatter,
whose eigenvectors are found on the driver, one number of dimensions squared. All rows are indexed
likewise, and their block matrix times the matrix of eigenvectors, each over the root of its eigenvalue,
gives their whitened components.

Rows are numbered by the file part they lie in and their place there, so numbers have gaps: blocks lack
those rows, or hold zeros for them, which add nothing. MLlib splits the rows' dimension of the
scatter product into ``MID_BLOCKS`` blocks a task and plans the product on the driver from the blocks'
numbers, a pair of numbers for ``BLOCK`` rows.

Rows are dropped whose vector is null, empty or holds nulls or numbers that are not finite or of
which x has no room in 64 bits (an absolute value above ``LARGEST``), and rows of another length than the
most frequent one (of equally frequent ones the longest). Null ids and repeated rows: each row has its
own result. Equal vectors are one row of the fit. Components whose eigenvalue is below ``LEAST`` of the largest
are none: constant dimensions, a single distinct vector or an empty table give fewer or no rows.
``deviation`` is null where it has no room in 64 bits. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseVector
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierlake.llm.frames import prepared
from dossierlake.session import materialize

COMPONENTS = 16
# How an entry becomes a whole number.
SCALE = 64
SHIFT = 1_000_000
LARGEST = 1.44e17
BLOCK = 1024
MID_BLOCKS = 64
LEAST = 1e-10

RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x of the rows whose vector has a whole number for each entry."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.transform(
        "v", lambda c: F.when(F.abs(c) <= LARGEST, F.floor(F.lit(SCALE) * c) + F.lit(SHIFT))
    )
    rows = rows.select("vec_id", whole.alias("x"))
    return rows.where((F.size("x") > 0) & ~F.exists("x", lambda x: x.isNull()))


def indexed(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows with a number of their own, whose block of ``BLOCK`` numbers lies in one file part."""
    number = F.monotonically_increasing_id()
    rows = rows.select("*", number.alias("number"))
    rows = materialize(
        rows.select(
            *[c for c in rows.columns if c != "number"],
            F.shiftright("number", 33).alias("part"),
            F.col("number").bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        purpose,
    )
    longest = rows.agg(F.max("place")).first()[0] or 0
    stride = (longest // BLOCK + 1) * BLOCK
    return rows.withColumn("index", F.col("part") * F.lit(stride) + F.col("place")).drop("part", "place")


def block_matrix(rows: DataFrame, base: list[int], rest: list[float]) -> BlockMatrix:
    """Blocks of the rows' x less the mean, which is the whole number ``base`` plus ``rest``."""
    whole, part = _array(base, "bigint"), _array(rest, "double")
    centred = F.transform("x", lambda x, i: (x - F.get(whole, i)).cast("double") - F.get(part, i))
    frame = rows.select("index", array_to_vector(centred).alias("vector"))
    frame = MLUtils.convertVectorColumnsFromML(frame, "vector")
    return IndexedRowMatrix(frame).toBlockMatrix(BLOCK, BLOCK)


def _array(values: list, kind: str) -> Column:
    return F.lit(values).cast(f"array<{kind}>")


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, in tasks of a bounded number of blocks."""
    splits = max(1, -(-blocks.numRows() // (BLOCK * MID_BLOCKS)))
    turned = blocks.transpose()
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def local_blocks(spark: SparkSession, matrix: np.ndarray) -> BlockMatrix:
    rows = [(i, DenseVector(row)) for i, row in enumerate(matrix)]
    return IndexedRowMatrix(spark.createDataFrame(rows, ["index", "vector"])).toBlockMatrix(BLOCK, BLOCK)


def projected(spark: SparkSession, blocks: BlockMatrix, matrix: np.ndarray) -> tuple[BlockMatrix, DataFrame]:
    """The product with a small matrix: its blocks, and its rows as index and array y."""
    product = blocks.multiply(local_blocks(spark, matrix))
    frame = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return product, frame.select("index", vector_to_array("vector").alias("y"))


def eigenvectors(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values > LEAST * max(values[0], 0.0)).sum()) if len(values) else 0
    kept = min(components, real)
    return values[:kept], vectors[:, :kept]


def deviation(n: int, base: list[int], left: list[int]) -> Column:
    """Sum of (n * x - S) ** 2 where S is n * base + left; null without room in 64 bits."""
    whole, over = _array(base, "bigint"), _array(left, "bigint")

    def square(x: Column, i: Column) -> Column:
        part = F.try_subtract(F.try_multiply(F.lit(n).cast("bigint"), x - F.get(whole, i)), F.get(over, i))
        return F.try_multiply(part, part)

    return F.aggregate(F.transform("x", square), F.lit(0).cast("bigint"), lambda a, b: F.try_add(a, b))


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row for each kept row and component; the columns of ``RESULT``."""
    spark = prepared(vectors.sparkSession)
    rows = indexed(whole_numbers(vectors, id_col, vector_col), "whole-numbers")
    size = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if size is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == size["size"])
    fit = indexed(rows.select("x").distinct(), "fit-list")
    n = fit.count()
    each = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    sums = [int(r["s"]) for r in each.orderBy("i").collect()]
    base = [s // n for s in sums]
    left = [s - n * b for s, b in zip(sums, base, strict=True)]
    rest = [r / n for r in left]

    blocks = block_matrix(fit, base, rest)
    covariance = scatter(blocks) / n
    values, axes = eigenvectors((covariance + covariance.T) / 2, components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    matrix = axes / np.sqrt(values)
    white, found = projected(spark, blocks, matrix)
    means = found.join(fit.select("index"), "index").select(F.posexplode("y")).groupBy("pos").agg(F.avg("col").alias("m"))
    means = np.array([r["m"] for r in means.orderBy("pos").collect()])
    error = np.abs(scatter(white) / n - np.outer(means, means) - np.eye(len(values))).max()

    _, found = projected(spark, block_matrix(rows, base, rest), matrix)
    share = _array((values / np.trace(covariance)).tolist(), "double")
    counted = rows.select("index", "vec_id", deviation(n, base, left).alias("deviation"))
    return counted.join(found, "index").select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
