"""Principal components of embeddings, whitened, by MLlib's BlockMatrix.

Entries become whole numbers, their sums are exact, rows get gapless indices.
The centred rows are indexed into distributed blocks; transpose times matrix
gives the scatter, whose products are dealt over as many tasks as there are row
blocks (``numMidDimSplits``) and added up; only that d x d matrix comes to the
driver, where ``numpy.linalg.eigh`` takes it apart. A second BlockMatrix product,
with the d x k whitening matrix, projects the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.numbering import with_positions
from rankflow.session import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: rows of a block: 2 MB at 64 dimensions
BLOCK_ROWS = 4096
#: row blocks that meet in one task of the scatter product
BLOCKS_A_TASK = 4
#: larger entries have no exact place in a long
_MOST = float(1 << 52)


def whole_numbers(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and ``x`` (array of long): floor(1024 c) + 100000 of each entry.

    Rows go whose vector is null or empty, holds a null, NaN or infinite entry,
    or one beyond 2^52 / 1024. Vectors must be of one length: those of another
    length than most rows have go as well (of equally common lengths the
    longest stays)."""
    v = F.col(f"`{vector}`").cast("array<double>")

    def good(c: Column) -> Column:
        return (c.isNotNull() & ~F.isnan(F.coalesce(c, F.lit(0.0)))
                & (F.abs(F.coalesce(c, F.lit(0.0))) <= F.lit(_MOST / SCALE)))

    rows = (vectors.select(F.col(f"`{key}`").cast("long").alias(key), v.alias("v"))
            .filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", good))
            .select(key, F.transform("v", lambda c: (F.floor(c * SCALE) + SHIFT).cast("long"))
                    .alias("x")))
    rows = materialize(rows, "whitening_rows")
    lengths = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), F.col("d").desc()).limit(2).collect())
    if len(lengths) > 1:
        rows = rows.filter(F.size("x") == lengths[0].d)
    return rows


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension (a row a dimension
    comes to the driver)."""
    found = (rows.select(F.posexplode("x").alias("i", "v")).groupBy("i")
             .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
                  F.count(F.lit(1)).alias("n")).collect())
    by = {r.i: r for r in found}
    return (by[0].n if by else 0), [int(by[i].s) for i in range(len(by))]


def _blocks(rows: DataFrame, values: Column, n: int, d: int, block_rows: int) -> BlockMatrix:
    """Rows (``_position``) as a distributed matrix of row blocks."""
    indexed = rows.select(F.col("_position").alias("index"), array_to_vector(values).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), n, d)
    return matrix.toBlockMatrix(block_rows, d)


def scatter(matrix: BlockMatrix, blocks_a_task: int = BLOCKS_A_TASK) -> np.ndarray:
    """Transpose times matrix. Left to itself the product of two such matrices
    has one block and so one task; splitting the middle dimension deals its
    terms out."""
    splits = max(1, -(-matrix.numRowBlocks // blocks_a_task))
    model = matrix._java_matrix_wrapper._java_model
    product = model.transpose().multiply(model, splits)
    d = matrix.numCols()
    return BlockMatrix(product, d, d).toLocalMatrix().toArray()


def whitening_matrix(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and d x k columns v / sqrt(e). Where an eigenvalue
    is zero to double precision the column is NaN. A vector's sign is such that
    its largest entry is positive."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    k = min(components, len(values))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(k)])
    real = values > max(values[0], 0) * len(cov) * np.finfo(float).eps * 4 if k else values > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        return values, np.where(real, vectors / np.sqrt(values), np.nan)


def project(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """index, projected (array of double): the rows times the matrix."""
    d, k = weights.shape
    block = spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, weights.T.reshape(-1).tolist()))], 1)
    product = matrix.multiply(BlockMatrix(block, d, k, d, k))
    rows = product.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    found = callMLlibFunc("getIndexedRows", rows)
    return found.select("index", vector_to_array("vector").alias("projected"))


def identity_error(projected: DataFrame, n: int, good: list[int]) -> float | None:
    """Largest absolute entry of the projections' covariance, centred first,
    less the identity."""
    if not good:
        return None
    c = {i: F.col("projected")[i] for i in good}
    means = projected.agg(*[F.sum(c[i]).alias(str(i)) for i in good]).first()
    c = {i: c[i] - F.lit(means[str(i)] / n) for i in good}
    pairs = [(i, j) for i in good for j in good if i <= j]
    got = projected.agg(*[F.sum(c[i] * c[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"{i}_{j}"] / n - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding",
           key: str = "vec_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a
    row for each usable vector (see :func:`whole_numbers`) and component, from 1,
    up to ``components`` or the number of dimensions.

    Repeated rows and null ids are rows like any other. A component whose
    eigenvalue is zero to double precision has a null ``whitened`` and is not
    part of ``identity_error``; where nothing varies at all ``explained`` is null
    too. A deviation beyond a long is null. No usable vector gives no rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = (f"{key} long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    usable = whole_numbers(vectors, vector, key)
    n, total = sums(usable)
    if not n:
        return spark.createDataFrame([], schema)
    d = len(total)
    rows = with_positions(usable)
    exact = "decimal(38,0)"
    s = F.array(*[F.lit(str(t)).cast(exact) for t in total])
    count = F.lit(n).cast("decimal(19,0)")
    spread = F.zip_with("x", s, lambda x, t: (count * x.cast("decimal(19,0)") - t).cast(exact))
    rows = materialize(rows.withColumn("spread", spread), "whitening_spread")
    centred = F.transform("spread", lambda y: y.cast("double") / F.lit(float(n)))
    matrix = _blocks(rows, centred, n, d, block_rows)
    cov = scatter(matrix) / n
    values, weights = whitening_matrix(cov, components)
    k = len(values)
    good = [i for i in range(k) if np.isfinite(weights[:, i]).all()]
    projected = materialize(project(spark, matrix, np.nan_to_num(weights)),
                            "whitening_projected")
    error = identity_error(projected, n, good)
    trace = float(np.trace(cov))
    explained = [float(values[i]) / trace if trace > 0 else None for i in range(k)]

    def add_square(total: Column, y: Column) -> Column:
        y = y.try_cast("decimal(19,0)")
        return F.try_add(total, F.try_multiply(y, y)).cast(exact)

    deviation = F.aggregate("spread", F.lit(0).cast(exact), add_square)
    parts = F.array(*[F.struct(
        F.lit(i + 1).alias("component"),
        (F.col("projected")[i] if i in good else F.lit(None).cast("double")).alias("whitened"),
        F.lit(explained[i]).cast("double").alias("explained")) for i in range(k)])
    return (rows.select(F.col("_position").alias("index"), key,
                        deviation.try_cast("long").alias("deviation"))
            .join(projected, "index").select(key, "deviation", F.explode(parts).alias("p"))
            .select(key, "p.component", F.lit(n).cast("long").alias("n"), "deviation", "p.whitened",
                    "p.explained", F.lit(error).cast("double").alias("identity_error")))
