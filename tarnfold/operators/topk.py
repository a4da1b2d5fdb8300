"""The first rows of each group, without sorting a group.

Each task keeps the first rows of the groups that it reads, in a table of
bounded size, and sends on only these.  A hot group has some from each task;
they meet by parts of the group first, and what is left of these by the group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .asof import ordered
from .compare import named

#: Rows that a task keeps of all its groups; more groups are sent on as they come.
KEPT = 1 << 16
#: Parts that a group's rows meet in first.
PARTS = 64


def changes(table: pa.Table, columns: Sequence[int]) -> np.ndarray:
    """Where a row has another key than the one before, by columns of flags and values."""
    out = np.zeros(table.num_rows, bool)
    for i in columns:
        flag = table[f"f{i}"].to_numpy()
        differs = pc.fill_null(pc.not_equal(table[f"v{i}"].slice(1), table[f"v{i}"].slice(0, table.num_rows - 1)), False)
        out[1:] |= (flag[1:] != flag[:-1]) | differs.to_numpy()
    out[:1] = True
    return out


def firsts(table: pa.Table, n_keys: int, order: Sequence[str], k: int) -> pa.Table:
    """The first ``k`` rows of each key; keys and then what they are ordered by are columns ``f`` and ``v`` each."""
    ways = ["ascending"] * n_keys + [f"{w}ending" for w in order]
    keys = [(f"{c}{i}", way) for i, way in enumerate(ways) for c in "fv"]
    table = table.take(pc.sort_indices(table, sort_keys=keys)).combine_chunks()
    begins = np.flatnonzero(changes(table, range(n_keys))) if n_keys else np.zeros(min(1, table.num_rows), np.int64)
    place = np.arange(table.num_rows) - np.repeat(begins, np.diff(np.append(begins, table.num_rows)))
    return table.filter(pa.array(place < k))


def keep_first(batches: Iterator[pa.RecordBatch], n_keys: int, order: Sequence[str], k: int, most: int) -> Iterator[pa.RecordBatch]:
    """A task's rows without those that can't be among the first, in the rows' own order or not."""
    kept: pa.Table | None = None
    waiting: list[pa.RecordBatch] = []
    rows = 0

    def settled() -> pa.Table:
        own = pa.Table.from_batches(waiting)
        return firsts(pa.concat_tables([kept, own]) if kept is not None else own, n_keys, order, k)

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= max(most, kept.num_rows if kept is not None else 0):
            kept, waiting, rows = settled(), [], 0
            if kept.num_rows >= most:
                # More groups than a task may hold: these are sent on as they are.
                yield from kept.select(["row"]).to_batches(10_000)
                kept = None
    if waiting:
        kept = settled()
    if kept is not None:
        yield from kept.select(["row"]).to_batches(10_000)


def top_k(df: DataFrame, on: Sequence[str], order: Sequence[str | tuple[str, str]], k: int, rank: str | None = None, most: int = KEPT) -> DataFrame:
    """The first ``k`` rows of each group of equal ``on`` columns, by ``order``; with ``rank``, their places in it, from 1.

    ``order`` has columns, ascending with nulls first, or pairs of a column and
    ``desc``, descending with nulls last; NaN is above all numbers.  Ties are
    decided by all other columns that have an order, ascending, so that only rows
    alike in these are left to chance.  Null keys are a group, as NaN ones are.
    Repeated rows count each.

    A task sorts ``most`` rows at once and keeps as many at most.  What leaves it
    is at most ``k`` rows a group each time that it is full of groups, so a group
    of any size comes to ``PARTS`` tasks as a few rows from each task.
    """
    chosen = [(c, "asc") if isinstance(c, str) else c for c in order]
    if any(w not in ("asc", "desc") for _, w in chosen) or k < 1:
        raise ValueError("an order is asc or desc, and k is at least 1")
    names = [c for c, _ in chosen]
    chosen += [(f.name, "asc") for f in df.schema.fields if ordered(f.dataType) and f.name not in (*on, *names)]

    def prepared(i: int, name: str) -> list:
        kind, c = df.schema[name].dataType, named(name)
        odd = F.isnan(c) if isinstance(kind, T.FloatType | T.DoubleType) else F.lit(False)
        flag = F.when(c.isNull(), 0).when(odd, 2).otherwise(1)
        value = c.cast("int") if isinstance(kind, T.BooleanType) else c
        return [flag.alias(f"f{i}"), F.when(flag == 1, value).alias(f"v{i}")]

    columns = [*on, *(c for c, _ in chosen)]
    whole = F.struct(*[named(c).alias(c) for c in df.columns]).alias("row")
    rows = df.select(whole, *[x for i, c in enumerate(columns) for x in prepared(i, c)])
    ways, n_keys = [w for _, w in chosen], len(on)
    schema = T.StructType([T.StructField("row", df.schema)])
    left = rows.mapInArrow(lambda batches: keep_first(batches, n_keys, ways, k, most), schema)
    keys = [F.col("row").getField(c) for c in on]
    by = [F.col("row").getField(c).desc() if w == "desc" else F.col("row").getField(c).asc() for c, w in chosen]
    by = by or [F.lit(0)]
    place = lambda *more: F.row_number().over(Window.partitionBy(*keys, *more).orderBy(*by))
    left = left.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    left = left.withColumn("place", place("part")).where(F.col("place") <= k).drop("place")
    left = left.withColumn("place", place()).where(F.col("place") <= k)
    out = [F.col("row").getField(c).alias(c) for c in df.columns]
    return left.select(*out, *([F.col("place").alias(rank)] if rank else []))
