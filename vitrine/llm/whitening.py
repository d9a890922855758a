"""Embedding whitening with Spark MLlib's BlockMatrix.

Entries become whole numbers (64ths, shifted), so their sums are exact. Rows are numbered,
centred on the exact mean and indexed into distributed blocks; the transposed blocks times the
blocks give the scatter matrix, whose eigenvectors are found locally (``eigh`` of dimension x
dimension numbers, however many rows there are). The blocks times the whitening matrix project
all rows, and the same product of the projected rows tells how far they are from white.

A product with a small result would bring all blocks to one task; ``multiply`` is given as many
splits of the inner dimension as there are groups of ``GROUP`` row blocks, each summed in a task
of its own before the few sums meet. Nothing but block numbers, sums by dimension and dimension
x dimension matrices reaches the driver; blocks grow with the number of rows, up to
``BLOCK_BYTES``, to keep the block numbers few.

Defined results: a vector that is null, empty, or holds a null, NaN, infinite or larger entry
than ``LARGEST`` in size is dropped, and so is one whose length is not the most frequent length
(ties: the longer). Components whose eigenvalue is below ``LEAST`` of the largest do not exist
(no spread to divide by), so equal rows, or a single one, give no result rows. Repeated rows and
null ids are rows of their own. ``deviation`` is null where the exact value needs more than a
long. An empty table gives an empty result; columns beside the id and the vector are ignored,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries of this size and above are no numbers here: their whole numbers leave 32 bits.
LARGEST = float(1 << 25)
#: Smallest eigenvalue of a component, as a share of the largest.
LEAST = 1e-11
#: Row blocks: rows at least, bytes at most, and how many a task multiplies.
BLOCK_ROWS, BLOCK_BYTES, BLOCKS, GROUP = 1024, 32 << 20, 4096, 4


@dataclass
class Whitener:
    """Exact count and sums, eigenvalues (falling) and unit eigenvectors (columns) of the fit."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the sound vectors of the most frequent length."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    sound = (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    x = written(src.where(sound).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")).alias("x")), "whitening-x")
    usual = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return x.where(F.size("x") == (usual["d"] if usual else 0))


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written with a gapless ``index``: places within the partitions, then one offset each."""
    place = F.monotonically_increasing_id()
    rows = written(df.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), label)
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()  # one row a partition
    offsets = np.cumsum([0] + [r["rows"] for r in sizes])[:-1]
    starts = df.sparkSession.createDataFrame([(r["part"], int(o)) for r, o in zip(sizes, offsets)], "part long, offset long")
    return rows.join(F.broadcast(starts), "part").select((F.col("offset") + F.col("place")).alias("index"), *df.columns)


def block_rows(n: int, d: int) -> int:
    return max(1, min(max(BLOCK_ROWS, -(-n // BLOCKS)), BLOCK_BYTES // (8 * d)))


def blocks(rows: DataFrame, n: int, d: int, per_block: int) -> BlockMatrix:
    """Distributed blocks, all columns wide, of (index, values array<double>)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(per_block, d)


def scatter(m: BlockMatrix) -> np.ndarray:
    """Transpose times itself: one partial sum per group of row blocks, then the sum of those."""
    splits = max(1, -(-m.numRowBlocks // GROUP))
    left, right = m.transpose()._java_matrix_wrapper._java_model, m._java_matrix_wrapper._java_model
    out = BlockMatrix(left.multiply(right, splits), m.colsPerBlock, m.colsPerBlock)
    return out.toLocalMatrix().toArray()


def project(spark: SparkSession, m: BlockMatrix, by: np.ndarray) -> DataFrame:
    """(index, values): the rows of the blocks times the local matrix ``by``."""
    d, k = by.shape
    rows = spark.createDataFrame([(i, Vectors.dense(row)) for i, row in enumerate(by.tolist())], ["index", "vector"])
    product = m.multiply(IndexedRowMatrix(rows, d, k).toBlockMatrix(d, k)).toIndexedRowMatrix()
    out = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return out.select("index", vector_to_array("vector").alias("values"))


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors, falling, each vector's largest entry positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors = values[order], vectors[:, order]
    keep = values > LEAST * max(values[0], 0.0) if len(values) else values > 0
    values, vectors = values[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, Whitener | None, float]:
    """((vec_id, x, whitened) of every fitted row, the fit, largest entry of the whitened rows'
    covariance less the identity). No fit: no rows."""
    spark = vectors.sparkSession
    x = numbered(whole_numbers(vectors, id_col, vec_col), "whitening-rows")
    by_dim = x.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    empty = x.select("vec_id", "x", F.lit(None).cast("array<double>").alias("whitened")).limit(0)
    if not by_dim:
        return empty, None, 0.0
    n, sums, d = by_dim[0]["n"], [r["s"] for r in by_dim], len(by_dim)
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    centred = x.select("index", F.zip_with("x", total, lambda a, s: (a * n - s).cast("double") / n).alias("values"))
    per_block = block_rows(n, d)
    m = blocks(centred, n, d, per_block)
    covariance = scatter(m) / n
    values, axes = principal(covariance, components)
    if not len(values):
        return empty, None, 0.0
    fit = Whitener(n, sums, float(np.trace(covariance)), values, axes)
    white = written(project(spark, m, fit.matrix), "whitening-projected")
    error = np.abs(scatter(blocks(white, n, len(values), per_block)) / n - np.eye(len(values))).max()
    return x.join(white.withColumnRenamed("values", "whitened"), "index").select("vec_id", "x", "whitened"), fit, float(error)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fit, error = whiten(table(spark, sf_dir, "embeddings"))
    n, sums = (fit.n, fit.sums) if fit else (0, [0])
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    rough = F.aggregate(F.zip_with("x", total, lambda a, s: F.pow(a.cast("double") * n - s.cast("double"), F.lit(2.0))), F.lit(0.0), lambda t, q: t + q)
    exact = F.aggregate(F.zip_with("x", total, lambda a, s: (a * n - s) * (a * n - s)), F.lit(0).cast("long"), lambda t, q: t + q)
    share = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values]) if fit else F.array(F.lit(0.0))
    return (rows.select("vec_id", F.when(rough < 9.0e18, exact).alias("deviation"), F.posexplode("whitened").alias("pos", "whitened"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("pos")).alias("explained"), F.lit(error).alias("identity_error")))
