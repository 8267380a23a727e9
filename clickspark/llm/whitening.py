"""Whitening of embeddings with distributed block matrices."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.names import unused
from clickspark.sources.shared import materialize, shared_path

_LONG_LIMIT = 1 << 63
_FIT = 1 << 20  # bytes of a block
_BLOCKS_A_TASK = 64
_PLACE = T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])


@dataclass(frozen=True)
class Moments:
    """Number of vectors, and of each dimension the sum, the least and the greatest entry."""

    n: int
    sums: list
    least: list
    most: list

    @property
    def dims(self) -> int:
        return len(self.sums)


@dataclass(frozen=True)
class Whitened:
    """``rows`` with the column ``whitened``; eigenvalues of the components (falling),
    the trace of the covariance, and the components as columns."""

    rows: DataFrame
    values: np.ndarray
    trace: float
    components: np.ndarray


def finite(vec: str) -> Column:
    """Whether a vector has entries, and all are numbers."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, lambda c: entry(c.cast("double"))), F.lit(False))


def usable(rows: DataFrame, vec: str = "embedding") -> DataFrame:
    """``rows`` whose vector can be whitened: not null or empty, without null or
    non-finite entries, and as long as most vectors (of equally common lengths,
    the greatest). A vector of another length has no place in the same space."""
    good = rows.where(finite(vec))
    lengths = good.groupBy(F.size(vec).alias("dims")).count()
    dims = lengths.orderBy(F.desc("count"), F.desc("dims")).select("dims").first()
    return good.where(F.size(vec) == (dims[0] if dims else 0))


def moments(rows: DataFrame, vec: str = "embedding") -> Moments:
    """Moments of vectors of one length without nulls. Sums of whole numbers are exact."""
    each = rows.select(F.posexplode(vec).alias("k", "x")).groupBy("k")
    found = each.agg(F.count("x"), F.sum("x"), F.min("x"), F.max("x")).orderBy("k").collect()
    return Moments(found[0][1] if found else 0, *([r[c] for r in found] for c in (2, 3, 4)))


def deviation(vec: str, m: Moments) -> Column:
    """Sum of ``(n * x - sum)^2`` over the dimensions, for whole numbers: exact.

    The moments bound it. Where that leaves the range of long, terms are
    decimals; a total that is no long is null.
    """
    reach = max((max(m.n * b - s, s - m.n * a) for s, a, b in zip(m.sums, m.least, m.most)), default=0)
    wide = m.dims * reach**2 >= _LONG_LIMIT
    sums = F.array(*(F.lit(s).cast("long") for s in m.sums)) if m.sums else F.array().cast("array<long>")

    def square(x: Column, s: Column) -> Column:
        off = x * F.lit(m.n).cast("long") - s
        return off.cast("decimal(19,0)") * off.cast("decimal(19,0)") if wide else off * off

    zero = F.lit(0).cast("decimal(38,0)" if wide else "long")
    add = lambda a, b: (a + b).cast("decimal(38,0)") if wide else a + b
    total = F.aggregate(F.zip_with(vec, sums, square), zero, add)
    return total.try_cast("long")


def whiten(
    rows: DataFrame, m: Moments, vec: str = "embedding", components: int = 8
) -> Whitened:
    """``rows`` (vectors as ``moments`` takes them) projected on their principal
    components, each divided by the root of its variance.

    Rows are centred and indexed into blocks where they lie: a block holds rows
    of one task, so no row is shuffled for it. The transposed matrix times the
    matrix is the scatter, multiplied in parts and added up; its eigenvectors are
    found on the driver (``dims`` squared numbers), and the blocks times the
    whitening matrix are the projections. They come back to the other columns of
    their rows block by block. MLlib plans a product on the driver from the
    places of all blocks: two integers for each MB of vectors.

    Components are unit eigenvectors of the covariance (divisor ``n``), by
    falling eigenvalue, with their largest entry positive; those without
    variance, in double precision, are left out, so that there may be fewer than
    ``components``, or none (equal vectors, one vector, no vector: then
    ``whitened`` is empty). Repeated rows each keep their row; the vector's column
    goes, other columns stay, and one named ``whitened`` is replaced.
    """
    spark = rows.sparkSession
    others = [c for c in rows.columns if c not in (vec, "whitened")]
    none = F.array().cast("array<double>").alias("whitened")
    bare = rows.select(*(F.col(f"`{c}`") for c in others))
    if m.n == 0:
        return Whitened(bare.select("*", none), np.zeros(0), 0.0, np.zeros((m.dims, 0)))
    height = max(1, min(10_000, _FIT // (8 * m.dims)))
    blocks, n_blocks = _indexed(rows, m, vec, others, height)
    matrix = _as_matrix(blocks, n_blocks, height, m.dims)
    parts = -(-n_blocks // _BLOCKS_A_TASK)
    java = matrix._java_matrix_wrapper._java_model
    scatter = BlockMatrix(java.transpose().multiply(java, parts), m.dims, m.dims)
    cov = scatter.toLocalMatrix().toArray() / m.n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    varied = values > max(values[0], 0) * m.dims * np.finfo(float).eps * 4
    k = min(components, int(varied.sum()))
    values, vectors = values[:k], vectors[:, :k]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    if k == 0:
        return Whitened(bare.select("*", none), values, float(np.trace(cov)), vectors)
    turn = DenseMatrix(m.dims, k, (vectors / np.sqrt(values)).ravel(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), turn)], 1), m.dims, k)
    placed = matrix.multiply(right)
    blocks_of = callMLlibFunc("getMatrixBlocks", placed._java_matrix_wrapper._java_model)
    written = shared_path(spark, "projected")
    blocks_of.toDF("place", "matrix").write.parquet(written)
    # Read as what a matrix consists of: its columns one after the other.
    plain = "place struct<_1 int, _2 int>, matrix struct<numRows int, values array<double>>"
    projected = spark.read.schema(plain).parquet(written)
    joined = blocks.select("block", "others").join(
        projected.select(F.col("place._1").cast("long").alias("block"), "matrix"), "block"
    )
    at = lambda i, j: F.get("matrix.values", i + j * F.col("matrix.numRows"))
    row = lambda o, i: F.struct(
        *(o[c].alias(c) for c in others), F.array(*(at(i, F.lit(j)) for j in range(k))).alias("whitened")
    )
    told = joined.select(F.inline(F.transform("others", row)))
    return Whitened(told, values, float(np.trace(cov)), vectors)


def _indexed(
    rows: DataFrame, m: Moments, vec: str, others: list[str], height: int
) -> tuple[DataFrame, int]:
    """Blocks of centred rows, written: ``block`` numbers them from 0 without gaps. And
    how many there are."""
    whole = [s // m.n for s in m.sums]
    rest = [s / m.n - w if isinstance(s, float) else (s - w * m.n) / m.n for s, w in zip(m.sums, whole)]
    shift, rest = np.array(whole, np.float64), np.array(rest, np.float64)
    (mark,) = unused(others, "blank")
    packed = F.struct(*(F.col(f"`{c}`") for c in others), F.lit(True).alias(mark))
    taken = rows.select(F.col(f"`{vec}`").cast("array<double>").alias("vec"), packed.alias("others"))
    schema = T.StructType(
        [
            T.StructField("task", T.IntegerType()),
            T.StructField("k", T.IntegerType()),
            T.StructField("matrix", MatrixUDT()),
            T.StructField("others", T.ArrayType(taken.schema["others"].dataType)),
        ]
    )
    centre = functools.partial(_centred, height, shift, rest)
    made = materialize(taken.mapInArrow(centre, schema), "blocks")
    # As many rows as the writing had tasks, with the blocks that earlier tasks have.
    sizes = made.groupBy("task").agg(F.count("*").alias("n")).orderBy("task").collect()
    first, before = [], 0
    for r in sizes:
        first.append((r["task"], before))
        before += r["n"]
    starts = rows.sparkSession.createDataFrame(first, "task int, before long")
    return made.join(F.broadcast(starts), "task").select(
        (F.col("before") + F.col("k")).alias("block"), "matrix", "others"
    ), before


def _as_matrix(blocks: DataFrame, n: int, height: int, dims: int) -> BlockMatrix:
    """MLlib's matrix of the table, made without passing through Python. Blocks may
    be lower than ``height``; the rows they lack count as zeros."""
    at = F.struct(F.col("block").alias("_1"), F.lit(0).cast("long").alias("_2"))
    java = callMLlibFunc(
        "createBlockMatrix", blocks.select(at.cast(_PLACE).alias("at"), "matrix"), height, dims, n * height, dims
    )
    return BlockMatrix(java, height, dims)


def _centred(
    height: int, shift: np.ndarray, rest: np.ndarray, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, k = TaskContext.get().partitionId(), 0
    ints, longs = pa.list_(pa.field("element", pa.int32(), False)), pa.field("element", pa.float64(), False)
    kinds = [
        pa.field("type", pa.int8(), False),
        pa.field("numRows", pa.int32(), False),
        pa.field("numCols", pa.int32(), False),
        pa.field("colPtrs", ints),
        pa.field("rowIndices", ints),
        pa.field("values", pa.list_(longs)),
        pa.field("isTransposed", pa.bool_(), False),
    ]
    for batch in batches:
        for at in range(0, batch.num_rows, height):
            part = batch.slice(at, height)
            n = part.num_rows
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, len(shift))
            x = (x - shift) - rest
            values = pa.ListArray.from_arrays(pa.array([0, x.size], pa.int32()), pa.array(x.ravel()))
            none = pa.array([None], ints)
            # Row by row, which to MLlib is a transposed matrix.
            columns = [
                pa.array([1], pa.int8()),
                pa.array([n], pa.int32()),
                pa.array([len(shift)], pa.int32()),
                none,
                none,
                values.cast(kinds[5].type),
                pa.array([True]),
            ]
            others = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task], pa.int32()),
                    pa.array([k], pa.int32()),
                    pa.StructArray.from_arrays(columns, fields=kinds),
                    others,
                ],
                ["task", "k", "matrix", "others"],
            )
            k += 1


def identity_error(found: Whitened) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the
    identity, from all rows; 0 without components."""
    k = len(found.values)
    part = lambda i: F.get("whitened", F.lit(i))
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    if not pairs:
        return 0.0
    # covar_pop combines centred sums of tasks.
    row = found.rows.agg(*(F.covar_pop(part(i), part(j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
