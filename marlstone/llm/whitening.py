"""Whitening of embeddings with block matrices.

Centred rows are indexed into the blocks of an MLlib ``BlockMatrix``; its transpose times itself is the
scatter matrix, whose eigenvectors (a local ``eigh``: dimensions x dimensions numbers) make
the whitening matrix, and a second block multiplication projects the rows.

The middle dimension of the first product is cut into splits of a fixed number of blocks, so that a
task holds that many blocks and not a share of all rows.  The blocks are written once: their numbers
stay as they are, whatever runs again.  The driver sees sums per dimension, one number per block
(``BlockMatrix`` plans its products there) and the scatter matrix.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import map_batches, stored, table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
ROWS_PER_BLOCK, COLUMNS_PER_BLOCK, BLOCKS_PER_SPLIT = 1024, 1024, 32
LARGEST = 1 << 40
# Directions with less than this share of the variance carry rounding only and are left out.
LEAST_SHARE = 1e-11


def shifted_integers(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry, c as double."""
    def whole(c):
        scaled = F.floor(F.lit(float(scale)) * c.cast("double"))
        too_large = F.raise_error(F.lit(f"an entry is {LARGEST} or more after scaling"))
        # The planner may ask this of vectors that are left out later: their entries must not raise.
        return F.when(~(F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(None)).when(
            F.abs(scaled) >= LARGEST, too_large).otherwise(scaled + F.lit(shift))

    return F.transform(vector, whole)


def finite(vector: Column) -> Column:
    entries = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & entries, F.lit(False))


def exact_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in 64 bits where all of it fits, else as Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squared_lengths(offsets: np.ndarray) -> list[int | None]:
    """Exact sums of squares per row; null where a long cannot hold one."""
    if offsets.dtype == object or offsets.shape[1] * int(np.abs(offsets).max(initial=0)) ** 2 >= 1 << 63:
        exact = (offsets.astype(object) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]
    return (offsets * offsets).sum(axis=1).tolist()


def _matrix_struct(values: np.ndarray) -> dict:
    """A dense matrix in the form its column type stores: values by column."""
    rows, columns = values.shape
    return {"type": 1, "numRows": rows, "numCols": columns, "colPtrs": None, "rowIndices": None,
            "values": values.ravel(order="F"), "isTransposed": False}


_MATRIX = pa.struct([
    ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
    ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])


def centred_blocks(
    fit: DataFrame, ident: str, n: int, sums: list[int], rows_per_block: int, columns_per_block: int
) -> DataFrame:
    """Blocks of centred rows with their numbers, written once.

    Columns: blockRowIndex, blockColIndex, subMatrix; in the first column block also the rows' ``ids`` and
    ``deviations``.  A task's last block is filled up with zero rows, which add nothing.
    """
    dims = len(sums)
    kind = fit.schema[ident].dataType

    def make():
        part, seq = TaskContext.get().partitionId(), 0

        def work(batch):
            nonlocal seq
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            out = {c: [] for c in ("part", "seq", "blockColIndex", "ids", "deviations", "subMatrix")}
            for at in range(0, len(x), rows_per_block):
                offsets = exact_offsets(x[at:at + rows_per_block], n, sums)
                centred = np.zeros((rows_per_block, dims))
                centred[:len(offsets)] = (offsets / n).astype(float)
                for block, first in enumerate(range(0, dims, columns_per_block)):
                    cells = centred[:, first:first + columns_per_block]
                    ids = None if block else batch.column(0).slice(at, rows_per_block).to_pylist()
                    for c, v in zip(out, (part, seq, block, ids, None if block else squared_lengths(offsets),
                                          _matrix_struct(cells))):
                        out[c].append(v)
                seq += 1
            return out | {"ids": pa.array(out["ids"], pa.list_(batch.schema.field(0).type)),
                          "subMatrix": pa.array(out["subMatrix"], _MATRIX)}

        return work

    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("blockColIndex", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("deviations", T.ArrayType(T.LongType())), T.StructField("subMatrix", MatrixUDT())])
    blocks = stored(map_batches(fit, schema, make), "centred-blocks")
    # One narrow row per task that wrote blocks.
    per_part = blocks.where("blockColIndex = 0").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(base, "part").withColumn("blockRowIndex", F.col("base") + F.col("seq"))


def _block_matrix(blocks: DataFrame, rows_per_block: int, columns_per_block: int, rows: int, columns: int) -> BlockMatrix:
    cells = blocks.select(F.struct("blockRowIndex", "blockColIndex"), "subMatrix")
    model = callMLlibFunc("createBlockMatrix", cells, rows_per_block, columns_per_block, rows, columns)
    return BlockMatrix(model, rows_per_block, columns_per_block)


def scatter_matrix(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose of a tall matrix times itself; its rows are dealt over ``splits`` groups."""
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors over the root of their eigenvalue, by falling eigenvalue, and each one's share of the variance."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    total = np.trace(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > LEAST_SHARE * total]
    return vectors[:, order] / np.sqrt(values[order]), values[order] / total if total else values[order]


def project(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """Projected rows by block: ``blockRowIndex``, ``subMatrix`` (rows of the block x components)."""
    spark, width = SparkSession.getActiveSession(), matrix.colsPerBlock
    parts = [((k, 0), DenseMatrix(*cut.shape, cut.ravel(order="F")))
             for k, cut in enumerate(whitening[i:i + width] for i in range(0, len(whitening), width))]
    right = BlockMatrix(
        spark.sparkContext.parallelize(parts, 1), width, whitening.shape[1], *whitening.shape)
    found = callMLlibFunc("getMatrixBlocks", matrix.multiply(right)._java_matrix_wrapper._java_model)
    index, cells = found.columns
    return found.select(F.col(index).getField("_1").cast("long").alias("blockRowIndex"), F.col(cells).alias("projected"))


def rows_of_blocks(batch: pa.RecordBatch, ident: str, width: int) -> dict:
    """Columns of the rows in blocks of (ids, deviations, projected); the rows a block was filled up with are left out."""
    ids, deviations = batch.column(0), batch.column(1)
    rows = []
    for length, cells in zip(pc.list_value_length(ids).to_pylist(), batch.column(2).to_pylist()):
        rows.append(np.array(cells["values"]).reshape((-1, width), order="F")[:length])
    z = np.concatenate(rows)
    offsets = np.arange(0, z.size + 1, width, dtype=np.int32)
    return {ident: ids.flatten(), "deviation": deviations.flatten(), "z": pa.ListArray.from_arrays(offsets, z.ravel())}


def whiten(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, shift: int = SHIFT, rows_per_block: int = ROWS_PER_BLOCK,
    columns_per_block: int = COLUMNS_PER_BLOCK,
) -> tuple[DataFrame, int, list[float]]:
    """Rows (``ident``, deviation, z: array of whitened components), their number, the components' shares of the variance.

    Vectors that are null or hold a null or non-finite entry are left out, and so are those whose
    length is not the table's most frequent one (the longer of equally frequent ones), since they have no place in a
    covariance.  Components without variance are left out: with equal vectors everywhere, ``z`` is
    empty.  Repeated rows count as often as they come, null identifiers stay, an empty table gives no
    rows, other columns are not read.  A deviation that a long cannot hold is null; entries of 2**40
    or more after scaling raise an error.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(ident), F.col(vector).alias("_v")).where(finite(F.col("_v")))
    lengths = kept.groupBy(F.size("_v").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    kind = vectors.schema[ident].dataType.simpleString()
    if common is None or not common["dims"]:
        return spark.createDataFrame([], f"`{ident}` {kind}, deviation long, z array<double>"), 0, []
    dims, n = common["dims"], common["n"]
    fit = kept.where(F.size("_v") == dims).select(ident, shifted_integers(F.col("_v"), scale, shift).alias("_x"))
    per_dimension = fit.select(F.posexplode("_x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s"))
    sums = [r["s"] for r in sorted(per_dimension.collect())]

    blocks = centred_blocks(fit, ident, n, sums, rows_per_block, columns_per_block)
    count = blocks.where("blockColIndex = 0").count()
    matrix = _block_matrix(blocks, rows_per_block, columns_per_block, count * rows_per_block, dims)
    covariance = scatter_matrix(matrix, -(-count // BLOCKS_PER_SPLIT)) / n
    whitening, shares = whitening_matrix(covariance, components)
    width = len(shares)
    named = blocks.where("blockColIndex = 0").select("blockRowIndex", "ids", "deviations")
    if not width:
        flat = named.select(F.inline(F.arrays_zip("ids", "deviations")).alias(ident, "deviation"))
        return flat.withColumn("z", F.array().cast("array<double>")), n, []

    joined = named.join(project(matrix, whitening), "blockRowIndex").select("ids", "deviations", "projected")
    schema = f"`{ident}` {kind}, deviation long, z array<double>"
    return stored(map_batches(joined, schema, lambda: partial(rows_of_blocks, ident=ident, width=width)), "whitened"), n, shares.tolist()


def identity_error(rows: DataFrame, width: int) -> float:
    """Largest absolute entry of the covariance of ``z`` minus the identity."""
    wide = rows.select(*[F.get("z", F.lit(i)).alias(f"z{i}") for i in range(width)])
    off = [F.abs(F.covar_pop(f"z{i}", f"z{j}") - F.lit(float(i == j))) for i in range(width) for j in range(i, width)]
    return wide.agg(F.array_max(F.array(*off))).first()[0]


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n, shares = whiten(table(spark, sf_dir, "embeddings"))
    error = identity_error(rows, len(shares)) if shares else None
    return rows.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
