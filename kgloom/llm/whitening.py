"""Embedding whitening by MLlib's BlockMatrix.

The distinct vectors, less their mean, are indexed and laid out as a matrix of distributed
blocks; its transpose times itself is the scatter matrix. Only that one, as wide as a vector,
comes to the driver, where its eigenvectors over the roots of their eigenvalues make the
whitening matrix. A second product projects the rows of all vectors.

Products are cut along the rows (``numMidDimSplits``): without, all blocks of a narrow matrix
would meet in the one task that owns the result. Sums are exact integers, taken before
anything is divided, so the mean does not depend on the order of the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgloom.session import materialized, scratch_path

from .common import numbered_parts, table

#: entries are taken in steps of one over this
STEPS = 256
COMPONENTS = 4
#: bytes of a block and of the blocks that one task multiplies, and columns of a block
BLOCK_BYTES, TASK_BYTES, BLOCK_COLUMNS = 1 << 20, 16 << 20, 1_024
#: a component with less of the variance than this has none
LEAST_SHARE = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def stepped(vector: Column) -> Column:
    """Entries as whole numbers of steps, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * STEPS).cast("long"))


def indexed(rows: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``rows``, written, with ``at`` from 0 without gaps; and how many they are."""
    rows = materialized(rows.withColumn("__row", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("__part", F.shiftright("__row", 33))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    # one row for each task that wrote
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__part", (F.coalesce(before, F.lit(0)) - F.shiftleft(F.col("__part"), 33)).alias("__shift"), "n")
    found = rows.join(F.broadcast(starts.drop("n")), "__part").withColumn("at", F.col("__row") + F.col("__shift"))
    return found.drop("__row", "__part", "__shift"), rows.count()


def block_matrix(rows: DataFrame, mean: np.ndarray, n: int, label: str) -> BlockMatrix:
    """Rows (at, x) less the mean, as blocks.

    A block is gathered from its rows, a set number of bytes, and written in the layout of MLlib's matrix type, as which
    it is read again. (``IndexedRowMatrix.toBlockMatrix`` would send a pair of objects for each entry.)
    """
    spark, d = rows.sparkSession, len(mean)
    wide = min(d, BLOCK_COLUMNS)
    per_block = max(1, BLOCK_BYTES // (8 * wide))
    parts = numbered_parts(spark, n * d * 8, TASK_BYTES)
    near = rows.select(F.expr(f"at div {per_block}").alias("i"), "at", "x").repartition(parts, "i")
    gathered = near.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("rows"))
    centre = F.lit([float(m) for m in mean])
    centred = lambda r: F.zip_with(r["x"], centre, lambda x, m: x.cast("double") - m)
    each = gathered.select("i", F.transform("rows", centred).alias("rows"), F.explode(F.sequence(F.lit(0), F.lit((d - 1) // wide))).alias("j"))
    part = F.transform("rows", lambda r: F.slice(r, F.col("j") * wide + 1, F.lit(wide)))
    none = F.lit(None).cast("array<int>")
    dense = F.struct(
        F.lit(1).cast("byte").alias("type"), F.size("rows").alias("numRows"), F.least(F.lit(wide), F.lit(d) - F.col("j") * wide).cast("int").alias("numCols"),
        none.alias("colPtrs"), none.alias("rowIndices"), F.flatten(part).alias("values"), F.lit(True).alias("isTransposed"),
    )
    blocks = each.select(F.struct(F.col("i").alias("_1"), F.col("j").cast("long").alias("_2")).alias("_1"), dense.alias("_2"))
    path = scratch_path(spark, label)
    blocks.write.parquet(path)
    kind = T.StructType([T.StructField("_1", T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])), T.StructField("_2", MatrixUDT())])
    stored = spark.read.schema(kind).parquet(path).repartition(parts, "_1")
    return BlockMatrix(callMLlibFunc("createBlockMatrix", stored, per_block, wide, n, d), per_block, wide)


def gram(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself."""
    splits = max(1, -(-(matrix.numRows() * matrix.numCols() * 8) // TASK_BYTES))
    left, right = (m._java_matrix_wrapper._java_model for m in (matrix.transpose(), matrix))
    made = BlockMatrix(left.multiply(right, splits), matrix.colsPerBlock, matrix.colsPerBlock)
    return made.toLocalMatrix().toArray()


def times(matrix: BlockMatrix, local: np.ndarray) -> BlockMatrix:
    """The matrix times a small one."""
    d, k = local.shape
    step = matrix.colsPerBlock
    blocks = [((i, 0), DenseMatrix(len(b), k, b.ravel("F").tolist())) for i, b in enumerate(local[a : a + step] for a in range(0, d, step))]
    spark = SparkSession.active()
    small = BlockMatrix(spark.sparkContext.parallelize(blocks, 1), step, k, d, k)
    left, right = (m._java_matrix_wrapper._java_model for m in (matrix, small))
    return BlockMatrix(left.multiply(right, 1), matrix.rowsPerBlock, k)


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """(at, values): the rows of a matrix."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("at"), vector_to_array("vector").alias("values"))


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vectors`` whose vector is usable, with ``x`` (whole steps), n (distinct vectors), deviation, and of the leading
    components, in arrays: whitened, explained (shares of the variance); and identity_error.

    Rows whose vector is null or holds null, NaN or infinite entries go. The covariance is that of the distinct ``x``;
    repeated rows are projected each. Components without variance cannot be whitened and are left out, so equal vectors
    have none; an empty table has no rows. Vectors of different sizes are an error. Columns of the names above are
    replaced; others, whatever their names, are kept.
    """
    spark = vectors.sparkSession
    own = ["x", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in vectors.columns if c not in own or c == vector]
    rows = vectors.where(usable(F.col(vector))).select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), stepped(F.col(vector)).alias("x")
    )
    rows, n_rows = indexed(rows, "whitening-rows")
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} entries")
    fit, n = indexed(rows.select("x").distinct(), "whitening-fit")
    d = sizes[0] or 0
    sums = {r["i"]: r["s"] for r in fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect()}
    total = [int(sums[i]) for i in range(d)]
    mean = np.array([s / n for s in total])
    values, basis, error = np.zeros(0), np.zeros((d, 0)), 0.0
    if n and d:
        matrix = block_matrix(fit.select("at", "x"), mean, n, "whitening-fit-blocks")
        covariance = gram(matrix) / n
        values, basis = np.linalg.eigh((covariance + covariance.T) / 2)
        values, basis = values[::-1], basis[:, ::-1]
        has = values > LEAST_SHARE * max(float(np.trace(covariance)), 0.0)
        basis = (basis / np.sqrt(np.where(has, values, 1.0)))[:, has][:, :components]
    k = basis.shape[1]
    if k:
        error = float(np.abs(gram(times(matrix, basis)) / n - np.eye(k)).max())
        projected = rows_of(times(block_matrix(rows.select("at", "x"), mean, n_rows, "whitening-blocks"), basis))
        rows = rows.join(projected, "at")
    else:
        rows = rows.withColumn("values", F.array().cast("array<double>"))
    far = F.zip_with("x", F.lit(total).cast("array<long>") if d else F.array().cast("array<long>"), lambda x, s: F.lit(n) * x - s)
    deviation = F.aggregate(far, F.lit(0).cast("long"), lambda a, y: a + y * y)
    explained = [float(v) for v in values[:k] / values.sum()] if k else []
    return rows.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        *([] if vector == "x" else ["x"]),
        F.lit(n).cast("long").alias("n"),
        deviation.alias("deviation"),
        F.col("values").alias("whitened"),
        (F.lit(explained) if explained else F.array()).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = found.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return each.select(
        "vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("i")).alias("explained"), "identity_error"
    )
