r"""Whitening of embeddings with MLlib's ``BlockMatrix``.

Entries become whole numbers ``x = floor(scale * c) + shift``. Their sums over all rows are exact, and so are ``n * x - S``
and its squares; the centred entry ``(n * x - S) / n`` is rounded once. Centred rows are numbered without gaps and
gathered into dense blocks of consecutive rows, each a row of a written table in the form of MLlib's matrices, so that
blocks go from the table into a ``BlockMatrix`` and back without Python. The transpose times the matrix is the scatter;
over ``n`` it is the covariance, whose eigenvectors are found on the driver (``eigh`` of dimension x dimension numbers).
The matrix times the eigenvectors over the roots of their eigenvalues projects the rows, and the covariance of what comes
out, by the same multiplication, tells how far it is from the identity.

``BlockMatrix`` gathers what one task multiplies under one key, and lays results out on a square grid. Hence the scatter is
split along the rows into tasks of at most ``GROUP`` blocks, which return one small sum each; and for the projection the
blocks are keyed as a square grid, with the whitening matrix repeated on the diagonal, as a tall grid would put its blocks
into few tasks. The driver keeps the keys of all blocks of a multiplication, so blocks are handled in slabs of a bounded
number of blocks that grows with the cluster alone.

Defined results: null vectors, vectors with a null, NaN, infinite or (beyond 2^56) unrepresentable entry and empty ones are
dropped; so are vectors that have another length than the commonest (of several, the longest). Keys may be null or
repeated: rows are numbered by themselves. Equal rows give equal results. Components beyond the dimension do not exist; one
without variance (a constant dimension, fewer rows than dimensions) has 0 in ``whitened`` and is left out of the identity
error, which is null where no component varies. A ``deviation`` that is too large for 38 digits is null. An empty table
gives no rows. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import run_dir
from .common import cut

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# Bytes of a block, and blocks that a task multiplies together.
BLOCK_BYTES = 8 << 20
GROUP = 8
LARGEST = float(1 << 56)
# Shares of the largest eigenvalue below this, per dimension, are rounding.
NO_VARIANCE = 1e-14

_MATRIX = ("struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,values:array<double>,"
           "isTransposed:boolean>")


def whole_vectors(rows: DataFrame, vector: str, key: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """Rows (key, x) of usable vectors with their ``index`` from 0, and the dimension (0: none)."""
    usable = F.size("vector") > 0
    usable &= F.forall("vector", lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    flat = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(F.col("vector").isNotNull()).where(usable)
    length = flat.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    dimension = length["length"] if length else 0
    x = F.transform("vector", lambda c: F.floor(c.cast("double") * scale).cast("bigint") + F.lit(shift).cast("bigint"))
    placed = cut(flat.where(F.size("vector") == dimension).select("key", x.alias("x"), F.monotonically_increasing_id().alias("_at")))
    # Numbers count up from 0 within each task that wrote; one row per task is summed up.
    task, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("_task", (F.sum("n").over(W.orderBy("_task")) - F.col("n")).alias("_before"))
    joined = placed.withColumn("_task", task).join(F.broadcast(counts), "_task")
    return joined.select("key", "x", (F.col("_before") + place).alias("index")), dimension


def _sums(rows: DataFrame, dimension: int) -> tuple[int, list[int], int]:
    """Rows, exact sum of each dimension, and the largest range of one."""
    entries = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
    found = entries.orderBy("at").collect()
    return (found[0]["n"], [int(r["s"]) for r in found], max(r["high"] - r["low"] for r in found)) if found else (0, [], 0)


def centred(rows: DataFrame, n: int, sums: list[int], spread: int) -> DataFrame:
    """``rows`` (key, x, index) with ``values`` (x - S/n, rounded once) and ``deviation`` (sum of (n*x - S)^2, exact)."""
    small = 4 * len(sums) * (n * (spread + 1)) ** 2 < 1 << 63 and 4 * n * (max(map(abs, sums)) // n + spread + 1) < 1 << 63
    kind = "bigint" if small else "decimal(38,0)"
    total = F.array(*[F.lit(str(s)).cast(kind) for s in sums])
    part = F.zip_with("x", total, lambda x, s: F.try_subtract(F.try_multiply(x.cast(kind), F.lit(n).cast(kind)), s).cast(kind))
    rows = rows.select("key", "index", part.alias("q"))
    square = F.aggregate("q", F.lit(0).cast(kind), lambda t, q: F.try_add(t, F.try_multiply(q, q).cast(kind)).cast(kind))
    return rows.select("key", "index", F.transform("q", lambda q: q.cast("double") / F.lit(float(n))).alias("values"),
                       square.cast("decimal(38,0)").alias("deviation"))


def write_blocks(rows: DataFrame, dimension: int, block_rows: int, slab: int, path: str) -> None:
    """Dense blocks of ``block_rows`` consecutive rows (index, values), in folders of ``slab`` blocks."""
    dealt = rows.select(F.expr(f"index div {block_rows}").alias("block"), "index", "values").repartition("block")
    lists = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("index", "values"))).alias("rows"))
    none = F.lit(None).cast("array<int>")
    matrix = F.struct(
        F.lit(1).cast("tinyint").alias("type"), F.size("rows").alias("numRows"), F.lit(dimension).alias("numCols"),
        none.alias("colPtrs"), none.alias("rowIndices"), F.flatten(F.col("rows.values")).alias("values"), F.lit(True).alias("isTransposed"))
    lists.select("block", matrix.alias("matrix"), F.expr(f"block div {slab}").alias("slab")).write.partitionBy("slab").parquet(path)


def _blocks(spark: SparkSession, path: str, across: int, first: int = 0) -> DataFrame:
    """Blocks of a slab as MLlib wants them, numbered from ``first`` and keyed row by row of a grid ``across`` wide."""
    schema = StructType([StructField("block", LongType()), StructField("matrix", MatrixUDT())])
    at = F.col("block") - first
    place = F.struct(F.floor(at / across).alias("_1"), (at % across).alias("_2"))
    return spark.read.schema(schema).parquet(path).select(place.alias("_1"), F.col("matrix").alias("_2"))


def _matrix(blocks: DataFrame, block_rows: int, block_columns: int) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, block_rows, block_columns, 0, 0), block_rows, block_columns)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, its inner dimension split over tasks; Python's own method leaves that parameter out."""
    product = a._java_matrix_wrapper._java_model.multiply(b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(spark: SparkSession, path: str, block_rows: int, columns: int, splits: int) -> np.ndarray:
    """Transpose times matrix, for the blocks written at ``path``."""
    tall = _matrix(_blocks(spark, path, 1), block_rows, columns)
    return _times(tall.transpose(), tall, splits).toLocalMatrix().toArray()


def write_projected(spark: SparkSession, path: str, out: str, first: int, n_blocks: int, block_rows: int, whitening: np.ndarray) -> None:
    """The blocks at ``path`` times ``whitening``, as blocks with the same numbers."""
    dimension, columns = whitening.shape
    across = math.isqrt(n_blocks - 1) + 1
    matrix = Matrices.dense(dimension, columns, whitening.ravel("F"))
    diagonal = BlockMatrix(spark.sparkContext.parallelize([((k, k), matrix) for k in range(across)], across), dimension, columns)
    product = _matrix(_blocks(spark, path, across, first), block_rows, dimension).multiply(diagonal)
    keyed = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    keyed.select((F.col("_1._1") * across + F.col("_1._2") + F.lit(first).cast("bigint")).alias("block"), F.col("_2").alias("matrix")).write.parquet(out)


def _rows_of(blocks: DataFrame, block_rows: int) -> DataFrame:
    """``index`` and ``values`` of the rows of dense blocks (block, matrix as a plain struct)."""
    m = F.col("matrix")

    def entry(r: Column, c: Column) -> Column:
        return F.get(m["values"], F.when(m["isTransposed"], r * m["numCols"] + c).otherwise(c * m["numRows"] + r))

    lines = F.transform(F.sequence(F.lit(0), m["numRows"] - 1), lambda r: F.struct(
        r.alias("at"), F.transform(F.sequence(F.lit(0), m["numCols"] - 1), lambda c: entry(r, c)).alias("values")))
    lines = blocks.select("block", F.explode(lines).alias("line"))
    return lines.select((F.col("block") * block_rows + F.col("line.at")).alias("index"), F.col("line.values").alias("values"))


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT, block_bytes: int = BLOCK_BYTES, slab_blocks: int | None = None) -> DataFrame:
    """``key``, n, deviation, ``whitened`` (array, largest variance first), ``explained`` (array) and identity_error per usable row."""
    spark = rows.sparkSession
    numbered, dimension = whole_vectors(rows, vector, key, scale, shift)
    n, sums, spread = _sums(numbered, dimension) if dimension else (0, [], 0)
    if not n:
        return numbered.select("key", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened"),
                               F.array().cast("array<double>").alias("explained"), F.lit(None).cast("double").alias("identity_error")).where("false")
    tasks = max(2, spark.sparkContext.defaultParallelism)
    block_rows = max(1, min(block_bytes // (8 * dimension), -(-n // (2 * tasks))))
    n_blocks = -(-n // block_rows)
    slab = slab_blocks or GROUP * 2 * tasks
    slabs = [(s, s * slab, min(slab, n_blocks - s * slab)) for s in range(-(-n_blocks // slab))]
    folder = run_dir(spark, "whitening")
    values = centred(numbered, n, sums, spread)
    write_blocks(values.select("index", "values"), dimension, block_rows, slab, f"{folder}/blocks")

    inner = lambda path, columns: sum(scatter(spark, path(s), block_rows, columns, -(-b // GROUP) if b > 2 * tasks else b) for s, _, b in slabs) / n
    variance, axes = np.linalg.eigh(inner(lambda s: f"{folder}/blocks/slab={s}", dimension))
    variance, axes = variance[::-1], axes[:, ::-1]
    # Of both signs, the one whose largest coordinate is positive.
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(dimension)] < 0, -1.0, 1.0)
    shown = min(components, dimension)
    varies = variance[:shown] > NO_VARIANCE * dimension * max(variance[0], 0)
    whitening = np.where(varies, axes[:, :shown] / np.sqrt(np.where(varies, variance[:shown], 1)), 0)
    for s, first, b in slabs:
        write_projected(spark, f"{folder}/blocks/slab={s}", f"{folder}/projected/slab={s}", first, b, block_rows, whitening)
    off = np.abs(inner(lambda s: f"{folder}/projected/slab={s}", shown) - np.eye(shown))[np.ix_(varies, varies)]
    total = variance.sum()
    explained = [float(max(e, 0) / total) if total > 0 else 0.0 for e in variance[:shown]]

    projected = spark.read.schema(f"block bigint, matrix {_MATRIX}").parquet(*[f"{folder}/projected/slab={s}" for s, _, _ in slabs])
    found = _rows_of(projected, block_rows).join(values.select("key", "index", "deviation"), "index")
    return found.select(
        "key", F.lit(n).cast("bigint").alias("n"), "deviation", F.col("values").alias("whitened"),
        F.array(*map(F.lit, explained)).alias("explained"), F.lit(float(off.max()) if off.size else None).cast("double").alias("identity_error"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = rows.select(
        F.col("key").alias("vec_id"), "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.explained").alias("explained"), "identity_error")
