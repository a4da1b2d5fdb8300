"""Whitening of embeddings by a tiled covariance (operator 12).

Dimensions are cut into blocks of ``TILE`` or more, rows into blocks of ``ROWS``.  A
pair of dimension blocks is a tile of the covariance; its keys get the two
column blocks of every row block, multiply them, and sum what they get.  A key
has ``GROUP`` row blocks of a tile at most, so that a task holds a bounded part
whatever the rows and dimensions, and all keys of a tile are summed.  The tiles together are the
covariance, whose eigenvectors give the components.

Vectors are whole numbers here, ``x = floor(SCALE * c) + 1000000``, so that sums
and differences from the mean are exact: a centred entry is ``(n * x - S) / n``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import materialize, share, workspace

SCALE = 64
#: Least dimensions of a block, and most blocks: a value is sent to as many tiles as there are blocks, and one.
TILE, BLOCKS = 32, 8
#: Rows of a row block, row blocks that a tile's key gets at once, and values that a task works on at once.
ROWS, GROUP, VALUES = 1024, 16, 1 << 18
COMPONENTS = 32


def whole_numbers(column: pa.Array, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are vectors of ``size`` finite entries, and ``floor(SCALE * c)`` of these."""
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(at)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size) if size else np.zeros((len(at), 0))
    fine = np.isfinite(values).all(axis=1)
    scaled = np.floor(SCALE * values[fine])
    if scaled.size and np.abs(scaled).max() >= 1 << 62:
        raise OverflowError("an entry times 64 doesn't fit a long")
    return at[fine], scaled.astype(np.int64)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``VALUES`` entries of a list column."""
    sizes = np.asarray(batch.column(column).value_lengths().fill_null(0)).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // VALUES
    starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def sums_by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length of vectors: their number, and the sum of whole numbers of each dimension."""
    for whole in batches:
        for batch in slices(whole, 0):
            lengths = np.unique(np.asarray(batch.column(0).value_lengths().fill_null(-1)))
            for size in lengths[lengths > 0].tolist():
                _, x = whole_numbers(batch.column(0), size)
                if len(x):
                    if np.abs(x).max() >= (1 << 62) // len(x):
                        raise OverflowError("sums of entries don't fit a long")
                    columns = [[size], [len(x)], [x.sum(axis=0).tolist()]]
                    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["size", "n", "sums"])


def narrow(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers as the narrowest type that holds them."""
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if not x.size or np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max)
    return kind, x.astype(kind).tobytes()


def covariance(vectors: DataFrame, n: int, total: np.ndarray, tile: int = 0) -> np.ndarray:
    """The covariance of the whole numbers of the one column of ``vectors``, divisor ``n``, tile by tile.

    A column block goes to each tile that needs it, as bytes of the narrowest
    type; it is centred exactly, by the sums ``total``, where it is multiplied.
    """
    spark, size = vectors.sparkSession, len(total)
    tile = tile or max(TILE, -(-size // BLOCKS))
    spans = [(a, min(a + tile, size)) for a in range(0, size, tile)]
    sums = share(spark, total)
    kinds = {"i": pa.int32(), "j": pa.int32(), "block": pa.int64(), "n": pa.int32(), "left_kind": pa.string(), "left": pa.binary(), "right_kind": pa.string(), "right": pa.binary()}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in (part for whole in batches for part in slices(whole, 0)):
            _, x = whole_numbers(batch.column(0), size)
            for rows in (x[a : a + ROWS] for a in range(0, len(x), ROWS)):
                packed = [narrow(rows[:, lo:hi]) for lo, hi in spans]
                for i in range(len(spans)):
                    out = [(i, j, part << 32 | seq // GROUP, len(rows), *packed[i], *(packed[j] if j > i else (None, None))) for j in range(i, len(spans))]
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=[*kinds])
                seq += 1

    def multiply(table: pa.Table) -> pa.Table:
        def centred(at: int, kind: str, data: bytes) -> np.ndarray:
            lo, hi = spans[at]
            return (n * np.frombuffer(data, kind).astype(np.int64).reshape(-1, hi - lo) - sums()[lo:hi]) / n

        out = 0.0
        for row in table.to_pylist():
            left = centred(row["i"], row["left_kind"], row["left"])
            out = out + left.T @ (left if row["right"] is None else centred(row["j"], row["right_kind"], row["right"]))
        (top, _), (first, _) = spans[row["i"]], spans[row["j"]]
        r, c = np.indices(out.shape)
        return pa.table({"r": pa.array(top + r.ravel(), pa.int32()), "c": pa.array(first + c.ravel(), pa.int32()), "v": out.ravel()})

    schema = "i int, j int, block long, n int, left_kind string, left binary, right_kind string, right binary"
    products = vectors.mapInArrow(blocks, schema).groupBy("i", "j", "block").applyInArrow(multiply, "r int, c int, v double")
    return assembled(products, size) / n


def assembled(cells: DataFrame, size: int) -> np.ndarray:
    """The symmetric matrix of the sums of ``v`` at ``r`` and ``c``; it has one cell a pair of dimensions."""
    found = cells.groupBy("r", "c").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    r, c, v = (found[k].to_numpy() for k in ("r", "c", "v"))
    out[r, c] = v
    out[c, r] = v
    return out


def components(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; the greatest entry of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(len(values))] < 0, -1.0, 1.0)


def centred_rows(column: pa.Array, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are vectors, and ``n * x - S`` of these, exactly."""
    at, x = whole_numbers(column, len(total))
    if len(x) and np.abs(x).max() > ((1 << 62) - int(np.abs(total).max())) // n:
        raise OverflowError("n times an entry doesn't fit a long")
    return at, n * x - total


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS, tile: int = 0) -> DataFrame:
    """Rows of ``id_col`` and ``component``, 1 to ``most`` by falling eigenvalue, of every vector.

    Columns: ``n`` (vectors), ``deviation`` (squared distance of ``n * x`` from
    the sums, exact), ``whitened``, ``explained`` and ``identity_error`` (the
    largest absolute entry of the covariance of ``whitened`` minus the identity,
    measured over all rows).

    Vectors that are null or have null or non-finite entries are left out, and
    empty ones.  Where lengths differ the commonest one counts, of equally common
    ones the greatest, and vectors of others are left out.  Repeated rows and
    null ids count and are given each.  A component along which nothing varies
    (an eigenvalue below 1e-12 of the first) has a null ``whitened`` and is left
    out of ``identity_error``; where nothing varies at all, ``explained`` and
    ``identity_error`` are null.  Equal eigenvalues have any eigenvectors of
    theirs, the same for all rows.  Whole numbers beyond a long raise an
    ``OverflowError``.  Other columns are ignored; without vectors there are no
    rows.

    Nothing that grows with the rows leaves the tasks: what the driver gets are
    sums by dimension, and a value for each pair of dimensions.
    """
    spark = df.sparkSession
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = df.schema[id_col].dataType
    types = [kind, T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(*x) for x in zip(names, types, strict=True)])
    vectors = df.select(F.col(f"`{vector_col}`").alias("vector"))
    found = materialize(vectors.mapInArrow(sums_by_length, "size int, n long, sums array<long>"), f"{workspace(spark, 'whitening')}/sums")
    lengths = found.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    size, n = lengths
    by_dimension = found.where(F.col("size") == size).select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    total = np.array([r.s for r in by_dimension.orderBy("at").collect()], np.int64)
    cov = covariance(vectors, n, total, tile)
    values, directions = components(cov, most)
    varies = values > 1e-12 * max(values[0], 0)
    scaled = directions / np.sqrt(np.where(varies, values, 1))
    sent = share(spark, (total, scaled))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, scaled = sent()
        r, c = (x.ravel() for x in np.indices((scaled.shape[1] + 1,) * 2))
        for batch in (part for whole in batches for part in slices(whole, 0)):
            _, z = centred_rows(batch.column(0), n, total)
            if len(z):
                # A last column of ones gives the means.
                w = np.hstack([z / n @ scaled, np.ones((len(z), 1))])
                columns = [pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array((w.T @ w).ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["r", "c", "v"])

    error = None
    if varies.any():
        second = assembled(vectors.mapInArrow(products, "r int, c int, v double"), len(values) + 1) / n
        spread = second[:-1, :-1] - np.outer(second[:-1, -1], second[:-1, -1])
        error = float(np.abs((spread - np.eye(len(values)))[np.ix_(varies, varies)]).max())
    trace = float(np.trace(cov))
    explained = [float(v) / trace if trace > 0 else None for v in values]
    id_type, k = to_arrow_type(kind), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, scaled = sent()
        for batch in (part for whole in batches for part in slices(whole, 1)):
            at, z = centred_rows(batch.column(1), n, total)
            if len(z) and (z.astype(float) ** 2).sum(axis=1).max() >= 9.2e18:
                raise OverflowError("a deviation doesn't fit a long")
            rows = len(z)
            again = np.repeat(np.arange(rows), k)
            columns = [
                batch.column(0).cast(id_type).take(pa.array(at)).take(pa.array(again)),
                pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                pa.array(np.full(rows * k, n), pa.int64()),
                pa.array((z * z).sum(axis=1)[again], pa.int64()),
                pa.array((z / n @ scaled).ravel(), pa.float64(), mask=np.tile(~varies, rows)),
                pa.array(explained * rows, pa.float64()),
                pa.array([error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{vector_col}`").alias("its vector")).mapInArrow(run, schema)
