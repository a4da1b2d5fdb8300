"""As-of join: each row with the last row of the other table before it, key by key.

Both tables go through one range shuffle by key and time, which cuts a hot key,
and even a hot instant, where its rows say, and not at its ends.  Each partition
is read once, in order, and carries the last right row along.  Left rows at its
start, whose right row lies in an earlier partition, get it from a table that
has one row a partition: what that one carried at its end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import shared_folder
from .compare import named

DONE, OPEN, FIRST, LAST = range(4)


def unlike(column: pa.Array, before: pa.Array) -> np.ndarray:
    """Whether values differ, NaN from NaN not."""
    out = pc.not_equal(column, before)
    if pa.types.is_floating(column.type):
        out = pc.and_(out, pc.invert(pc.and_(pc.is_nan(column), pc.is_nan(before))))
    return out.to_numpy(zero_copy_only=False)


def scan(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Left rows with what was carried to them, and the first and last key of the partition with what they end with.

    Columns of the input: ``l``, ``r``, whether the row is a right one, keys.  A
    left row of the partition's first key before any right row of it is open.
    """
    part = TaskContext.get().partitionId()
    carried = previous = first = schema = None
    in_first = True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        left, right, keys = batch.column(0), batch.column(1), batch.columns[3:]
        if previous is None:
            first = [k.slice(0, 1) for k in keys]
            previous, carried = first, pa.nulls(1, right.type)
            schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("l", left.type), ("r", right.type), *((f"k{i}", k.type) for i, k in enumerate(keys))])
        changed = np.zeros(n, bool)
        for k, p in zip(keys, previous, strict=True):
            changed |= unlike(k, pa.concat_arrays([p, k.slice(0, n - 1)]))
        at = np.arange(n)
        is_right = batch.column(2).to_numpy(zero_copy_only=False)
        run = np.maximum.accumulate(np.where(changed, at, -1))
        last = np.maximum.accumulate(np.where(is_right, at, -1))
        # -1: no right row of the run in this batch; before the first change the run is that of the batch before.
        own = np.where(last >= run, last, -1)
        begun = run < 0
        pool = pa.concat_arrays([right, carried])
        there = np.where(own >= 0, own, np.where(begun & carried.is_valid()[0].as_py(), n, -1))
        rows = np.flatnonzero(~is_right)
        took = pool.take(pa.array(there[rows], mask=there[rows] < 0))
        kind = np.where((there[rows] < 0) & begun[rows] & in_first, OPEN, DONE)
        empty = [pa.nulls(len(rows), k.type) for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(np.full(len(rows), part), pa.int32()), left.take(pa.array(rows)), took, *empty], schema=schema)
        carried = pool.take(pa.array([int(there[-1]) if there[-1] >= 0 else None], pa.int64()))
        if changed.any() and in_first:
            # The first key ends here: nothing later is its, so what it ends with doesn't matter.
            in_first = False
        previous = [k.slice(n - 1, 1) for k in keys]
    if previous is not None:
        for kind, keys, r in ((FIRST, first, pa.nulls(1, carried.type)), (LAST, previous, carried)):
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.nulls(1, schema.field("l").type), r, *keys], schema=schema)


def ordered(kind: T.DataType) -> bool:
    return not isinstance(kind, T.MapType | T.VariantType | T.ArrayType | T.StructType | T.CalendarIntervalType)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    on: Sequence[str] = (),
    direction: str = "backward",
    strict: bool = False,
    tolerance: Column | None = None,
    tie: Sequence[str] | None = None,
    how: str = "left",
    prefix: str = "right_",
    parts: int | None = None,
) -> DataFrame:
    """All columns of ``left``, and those of ``right`` under ``prefix``, of the nearest right row at or before it.

    ``on`` names key columns that both have, ``direction`` may be ``forward`` (at
    or after), ``strict`` leaves out equal times, and ``tolerance`` is the
    greatest distance in time, an interval or a number.  Of right rows of one
    time that with the greatest ``tie`` columns counts, in their order, nulls
    least; by default all columns that have an order, so that only rows alike in
    these are left to chance.  ``how`` is ``left`` or ``inner``.

    Every left row is there once; null keys or times match nothing.  Repeated
    rows stay.  ``parts`` is the number of partitions, by default that of
    shuffles; a task holds a batch, whatever a key's rows.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, and how is left or inner")
    spark, back = left.sparkSession, direction == "backward"
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ties = [f.name for f in right.schema.fields if ordered(f.dataType) and f.name not in (*on, right_time)] if tie is None else list(tie)
    l_type, r_type = left.schema, right.schema
    whole = lambda df: F.struct(*[named(c).alias(c) for c in df.columns])

    def usable(time: str) -> Column:
        out = named(time).isNotNull()
        for c in on:
            out = out & named(c).isNotNull()
        return out

    # At one time a right row comes before the left ones that may see it.
    def side(df: DataFrame, time: str, is_right: bool) -> DataFrame:
        none = lambda kind: F.lit(None).cast(kind)
        keys = [named(c).alias(f"k{i}") for i, c in enumerate(on)]
        tied = [(named(c) if is_right else none(right.schema[c].dataType)).alias(f"t{i}") for i, c in enumerate(ties)]
        place = F.lit(is_right != (not strict)).alias("place")
        rows = [none(l_type).alias("l"), whole(df).alias("r")] if is_right else [whole(df).alias("l"), none(r_type).alias("r")]
        # What deals an instant's left rows apart: of the row itself, so that a task that runs again deals alike.
        plain = [named(f.name) for f in l_type.fields if ordered(f.dataType)]
        spread = (F.lit(0) if is_right else F.xxhash64(*plain)).cast("long").alias("spread")
        return df.where(usable(time)).select(*rows, F.lit(is_right).alias("is_right"), *keys, named(time).alias("time"), place, *tied, spread)

    both = side(left, left_time, False).unionByName(side(right, right_time, True))
    names = [f"k{i}" for i in range(len(on))]
    order = [*names, F.col("time").asc() if back else F.col("time").desc(), "place", *[f"t{i}" for i in range(len(ties))], "spread"]
    dealt = both.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    key_types = [left.schema[c].dataType for c in on]
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("l", l_type), T.StructField("r", r_type), *[T.StructField(k, t) for k, t in zip(names, key_types, strict=True)]])
    path = shared_folder(spark, "asof")
    dealt.select("l", "r", "is_right", *names).mapInArrow(lambda it: scan(it, len(on)), schema).write.partitionBy("kind").parquet(path)
    kinds = spark.read.schema(T.StructType([f for f in schema.fields if f.name != "kind"] + [schema["kind"]])).parquet(path)

    done = kinds.where(F.col("kind") == DONE).select("l", "r")
    # One or two rows a partition: of each key, in the order of the partitions, the last right row before.
    ends = kinds.where(F.col("kind").isin(FIRST, LAST))
    before = Window.partitionBy(*names).orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", "kind", F.last("r", ignorenulls=True).over(before).alias("carried")).where(F.col("kind") == FIRST)
    waits = kinds.where(F.col("kind") == OPEN).select("part", "l")
    late = waits.join(carried.select("part", "carried"), "part", "left").select("l", F.col("carried").alias("r"))
    out = done.unionByName(late)
    if how == "left":
        out = out.unionByName(left.where(~usable(left_time)).select(whole(left).alias("l"), F.lit(None).cast(r_type).alias("r")))
    found = F.col("r").isNotNull()
    if tolerance is not None:
        own, other = F.col("l")[left_time], F.col("r")[right_time]
        found = found & ((other >= own - tolerance) if back else (other <= own + tolerance))
    if how == "inner":
        out = out.where(found)
    columns = [F.col("l").getField(c).alias(c) for c in left.columns]
    return out.select(*columns, *[F.when(found, F.col("r").getField(c)).alias(prefix + c) for c in right.columns])
