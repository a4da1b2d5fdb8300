"""Window frames over hot keys: a key's time is cut into stretches, and each is a task's own.

A frame of bounded reach needs rows of its own stretch and a halo of rows beside
it.  If what it asks for can be put together, it is the end of one stretch as
long as it reaches and the beginning of the next, each read off a running
aggregate, so that the work doesn't grow with the rows of a frame.  A frame from the beginning needs what all stretches before come to, which
is one number each.  So no task has more of a key than a stretch, whose length
is chosen by the rows of the most frequent key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .compare import named
from .ranges import position

#: Rows of one key that a stretch should hold.
ROWS = 1 << 17
#: How sums of stretches are put together.
TOGETHER = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
OWN = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def reach(span: timedelta | int) -> int:
    """A span as a distance of positions; Spark's frames have whole ones."""
    span = span // timedelta(microseconds=1) if isinstance(span, timedelta) else span
    if span != int(span) or span < 0:
        raise ValueError("a frame reaches a whole number, at least 0")
    return int(span)


def stretches(rows: DataFrame, keys: Sequence[str], least: float | int, per_key: int) -> float | int:
    """How long a stretch is, of a table with its ``__at``: the most frequent key's ``per_key`` rows, ``least`` at least."""
    sizes = rows.where("__at IS NOT NULL").groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("a"), F.max("__at").alias("b"))
    most, low, high = sizes.agg(F.max("n"), F.min("a"), F.max("b")).first()
    span = (high - low) * per_key / most if most else 0
    whole = dict(rows.dtypes)["__at"] == "bigint"
    return max(least, int(span), 1) if whole else max(float(least), span, 1e-300)


def stretch_of(at: Column, length: float | int) -> Column:
    return F.call_function("div", at - F.pmod(at, F.lit(length)), F.lit(length)) if isinstance(length, int) else F.floor(at / F.lit(length))


def own_of(aggregate: tuple[str, str]) -> Column:
    """A function of a column; ``*`` counts rows."""
    f, c = aggregate
    return OWN[f](F.lit(1) if (f, c) == ("count", "*") else named(c))


def summed_frames(rows: DataFrame, on: Sequence[str], before: int, after: int, aggregates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """All ``rows``, which have a whole ``__at``, and what their frames come to, put together from running aggregates.

    Rows of a key and instant are summed first.  Time is cut into stretches as
    long as a frame, so that each frame begins in one and ends in the next: what
    it comes to is the former's rows from its beginning on, and the latter's up
    to its end.  Two marks for each instant read these off; they hold nothing.
    """
    keys, values = [f"__k{i}" for i in range(len(on))], [f"__v{i}" for i in range(len(aggregates))]
    functions = [f for f, _ in aggregates.values()]
    instants = rows.groupBy(*[named(c).alias(k) for c, k in zip(on, keys, strict=True)], "__at").agg(*[own_of(a).alias(v) for a, v in zip(aggregates.values(), values, strict=True)])
    kinds = dict(instants.dtypes)
    frames = instants
    if before + after:
        holds, begins, ends = range(3)
        first, last = begins if before else holds, ends if after else holds

        def entry(kind: int, at: Column) -> Column:
            return F.struct(F.lit(kind).alias("__kind"), at.alias("__pos"), *[(F.col(v) if kind == holds else F.lit(None)).cast(kinds[v]).alias(v) for v in values])

        at = F.col("__at")
        entries = [entry(holds, at), *[entry(begins, at - F.lit(before))] * (before > 0), *[entry(ends, at + F.lit(after))] * (after > 0)]
        dealt = instants.where("__at IS NOT NULL").select(*keys, F.explode(F.array(*entries)).alias("__e")).select(*keys, "__e.*")
        dealt = dealt.withColumn("__in", stretch_of(F.col("__pos"), before + after))
        stretch = Window.partitionBy(*keys, "__in")
        up, down = (stretch.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.col("__pos").asc(), F.col("__pos").desc()))
        read = dealt.select(*keys, "__kind", "__pos", *[TOGETHER[f](v).over(w).alias(f"{v}{n}") for f, v in zip(functions, values, strict=True) for n, w in (("up", up), ("down", down))])
        is_first = F.col("__kind") == first
        read = read.where(F.col("__kind").isin(first, last)).select(*keys, F.when(is_first, F.col("__pos") + F.lit(before)).otherwise(F.col("__pos") - F.lit(after)).alias("__at"), *[F.when(is_first, F.col(f"{v}down")).otherwise(F.col(f"{v}up")).alias(v) for v in values])
        frames = read.groupBy(*keys, "__at").agg(*[TOGETHER[f](v).cast(kinds[v]).alias(v) for f, v in zip(functions, values, strict=True)])
        frames = frames.unionByName(instants.where("__at IS NULL"))
    frames = frames.withColumnRenamed("__at", "__its")
    same = F.col("__at").eqNullSafe(F.col("__its"))
    for c, k in zip(on, keys, strict=True):
        same = same & named(c).eqNullSafe(F.col(k))
    columns = [named(c) for c in rows.columns if c != "__at"]
    return rows.join(frames, same, "left").select(*columns, *[F.col(v).alias(n) for n, v in zip(aggregates, values, strict=True)])


def rolling(
    df: DataFrame,
    on: Sequence[str],
    time: str,
    preceding: timedelta | int,
    aggregates: Mapping[str, Column | tuple[str, str]],
    following: timedelta | int = 0,
    per_key: int = ROWS,
) -> DataFrame:
    """All rows, and aggregates over those of the same key from ``preceding`` before to ``following`` after each.

    The result is that of a range frame over the whole key.  Rows of one time are
    in each other's frames.  Null keys are a key; rows of null time are in each
    other's frames only.  Repeated rows stay.  A row is sent to its stretch and to
    the next ones that it may be in a frame of, two more at most; rows of one
    instant are in one task.

    An aggregate is a column, which Spark computes anew over each row's frame,
    so that time grows with rows times rows of a frame; or one of ``sum``,
    ``count``, ``min`` and ``max``, and a column's name (``*`` to count rows).
    If all are such, and times are whole numbers or times, each row is read a
    bounded number of times, however many rows a frame has, and ``per_key``
    isn't needed; an instant's rows may be in many tasks.
    """
    rows = df.withColumn("__at", position(df, time))
    before, after = reach(preceding), reach(following)
    if dict(rows.dtypes)["__at"] == "bigint" and all(isinstance(a, tuple) for a in aggregates.values()):
        return summed_frames(rows, on, before, after, aggregates)
    aggregates = {n: own_of(a) if isinstance(a, tuple) else a for n, a in aggregates.items()}
    length = stretches(rows, on, before + after, per_key)
    near = F.sequence(stretch_of(F.col("__at") - F.lit(after), length), stretch_of(F.col("__at") + F.lit(before), length))
    # What has no time has no stretch, but stays.
    rows = rows.withColumn("__in", F.explode_outer(near))
    frame = Window.partitionBy(*[named(k) for k in on], "__in").orderBy("__at").rangeBetween(-before, after)
    out = rows.select(*[named(c) for c in df.columns], "__at", "__in", *[c.over(frame).alias(n) for n, c in aggregates.items()])
    return out.where(F.col("__in").eqNullSafe(stretch_of(F.col("__at"), length))).drop("__at", "__in")


def running(df: DataFrame, on: Sequence[str], time: str, aggregates: Mapping[str, tuple[str, str]], per_key: int = ROWS) -> DataFrame:
    """All rows, and aggregates over those of the same key up to each one's time, equal times included.

    An aggregate is one of ``sum``, ``count``, ``min`` and ``max``, and a column.
    Within a stretch rows are summed in order; stretches are summed first, and
    what those before come to is added.  Null keys are a key; null times come
    before all others, as Spark orders them.  Repeated rows stay.
    """
    rows = df.withColumn("__at", position(df, time))
    length = stretches(rows, on, 0, per_key)
    rows = rows.withColumn("__in", stretch_of(F.col("__at"), length))
    keys = [named(k) for k in on]
    own = Window.partitionBy(*keys, "__in").orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select(*[named(c) for c in df.columns], "__in", *[OWN[f](named(c)).over(own).alias(n) for n, (f, c) in aggregates.items()])
    sums = rows.groupBy(*[k.alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__in").alias("__its")).agg(*[OWN[f](named(c)).alias(f"__{n}") for n, (f, c) in aggregates.items()])
    earlier = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__its").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[f"__k{i}" for i in range(len(keys))], "__its", *[TOGETHER[f](f"__{n}").over(earlier).alias(f"__{n}") for n, (f, _) in aggregates.items()])
    same = F.col("__in").eqNullSafe(F.col("__its"))
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"__k{i}"))
    both = {"min": F.least, "max": F.greatest}
    add = lambda x, y: F.when(x.isNull(), y).when(y.isNull(), x).otherwise(x + y)
    out = [both.get(f, add)(F.col(n), F.col(f"__{n}")).alias(n) for n, (f, _) in aggregates.items()]
    return local.join(sums, same, "left").select(*[named(c) for c in df.columns], *out)
