"""Interval join: pairs of rows whose closed intervals overlap, by bins that the data choose.

Intervals are put into levels by their length, each with bins four times as wide
as the one below, so that an interval lies in two bins of its level at most.  A
pair meets in the bins of the longer one's level: there its longer interval is
at home, the shorter one a guest.  Guests don't meet guests, for these have
their own level, and of the bins that a pair shares only that where the overlap
begins gives it.  All of it is one join on equal keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder
from .compare import named

#: Rows that a bin of the lowest level should hold, how much wider a level's bins are than those below, and levels at most.
DENSITY, WIDER, LEVELS = 64, 4, 32
#: Rows of one bin from which it is split, of either side.
HOT = 1 << 16
#: Hot bins that may be broadcast.
FEW = 10_000

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def position(df: DataFrame, name: str) -> Column:
    """A point as a number: times in microseconds, so that no session's time zone matters."""
    kind, c = df.schema[name].dataType, named(name)
    if isinstance(kind, WHOLE):
        return c.cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86_400_000_000
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(c) * 3600 + F.minute(c) * 60
        return F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    if isinstance(kind, T.FloatType | T.DoubleType | T.DecimalType):
        return c.cast("double")
    raise TypeError(f"{name}: intervals of {kind.simpleString()} aren't ordered by a number")


def placed(df: DataFrame, start: str, end: str, on: Sequence[str]) -> DataFrame:
    """Rows that have an interval: ``row``, keys, ``a`` and ``b``."""
    rows = df.select(F.struct(*[named(c).alias(c) for c in df.columns]).alias("row"), *[named(c).alias(f"k{i}") for i, c in enumerate(on)], position(df, start).alias("a"), position(df, end).alias("b"))
    out = rows.where("a <= b AND NOT isnan(a) AND NOT isnan(b) AND abs(a) < double('infinity') AND abs(b) < double('infinity')")
    for i in range(len(on)):
        out = out.where(f"k{i} IS NOT NULL")
    return out


def bin_of(point: Column, level: Column, width: float | int) -> Column:
    """The bin of a level that a point lies in."""
    if isinstance(width, int):
        wide = F.lit(width) * F.call_function("shiftleft", F.lit(1).cast("long"), (2 * level).cast("int"))
        return F.call_function("div", point - F.pmod(point, wide), wide)
    return F.floor(point / (F.lit(width) * F.pow(F.lit(float(WIDER)), level)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: Sequence[str] = (),
    prefix: str = "right_",
    width: float | int | None = None,
    hot: int = HOT,
) -> DataFrame:
    """Every pair of a ``left`` and a ``right`` row whose intervals share a point, and whose ``on`` columns are equal.

    A span names the columns of an interval's first and last point; both may be
    the same column, for points.  Columns of ``right`` come under ``prefix``.

    Null, NaN, infinite and reversed intervals, and null keys, match nothing.
    Touching intervals overlap.  Repeated rows make pairs each.  The lowest
    level's bins are as wide as ``DENSITY`` rows of a key need on average, and
    longer intervals go to higher levels, so a row is sent to two bins of each
    level that the other side has, and rows of one bin are compared with that
    bin's only.  Bins of more than ``hot`` rows are split on both sides.
    """
    one, two = placed(left, *left_span, on), placed(right, *right_span, on)
    spark = left.sparkSession
    path = shared_folder(spark, "overlap")
    keys = [f"k{i}" for i in range(len(on))]
    whole = dict(one.dtypes)["a"] == dict(two.dtypes)["a"] == "bigint"
    if not whole:
        one, two = (t.withColumn("a", F.col("a").cast("double")).withColumn("b", F.col("b").cast("double")) for t in (one, two))

    # Both tables are read several times, so what they come from is computed once.
    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{path}/{name}")
        return spark.read.schema(table.schema).parquet(f"{path}/{name}")

    one, two = kept(one, "left"), kept(two, "right")
    if width is None:
        both = one.select(*keys, "a", "b").unionByName(two.select(*keys, "a", "b"))
        distinct = F.approx_count_distinct(F.struct(*keys)) if keys else F.lit(1)
        n, low, high, own = both.agg(F.count(F.lit(1)), F.min("a"), F.max("b"), distinct).first()
        width = (high - low) * DENSITY * max(own, 1) / n if n else 1
        width = max(1, int(width)) if whole else float(width) or 1.0

    # The lowest level whose bins are at least as long as the interval.
    def levelled(table: DataFrame) -> DataFrame:
        length = (F.col("b").cast("double") - F.col("a").cast("double")) / width
        return table.withColumn("level", F.when(length <= 1, 0).otherwise(F.least(F.lit(LEVELS - 1 if not whole else 30), F.ceil(F.log(float(WIDER), length)))).cast("int"))

    one, two = levelled(one), levelled(two)
    levels = [sorted(r.level for r in t.select("level").distinct().collect()) for t in (one, two)]

    def binned(table: DataFrame, other: list[int], side: int) -> DataFrame:
        """A row for each bin that a pair with the other side's levels may meet in.

        ``guests`` says which join of that bin the row is for: 0, left rows at
        home with all right ones; 1, left guests with right rows at home.
        """
        own = F.array_distinct(F.transform(F.array(*[F.lit(x) for x in other]).cast("array<int>"), lambda x: F.greatest(x, F.col("level"))))
        table = table.withColumn("m", F.explode(own))
        home = F.col("level") == F.col("m")
        joins = (F.when(home, F.array(F.lit(0))).otherwise(F.array(F.lit(1)))) if side == 0 else F.when(home, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        table = table.withColumn("guests", F.explode(joins))
        return table.withColumn("bin", F.explode(F.sequence(bin_of(F.col("a"), F.col("m"), width), bin_of(F.col("b"), F.col("m"), width))))

    cell = [*keys, "m", "guests", "bin"]
    one, two = binned(one, levels[1], 0), binned(two, levels[0], 1)
    counts = one.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("o"))
    counts = counts.unionByName(two.groupBy(*cell).agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("o")))
    counts = counts.groupBy(*cell).agg(F.sum("n").alias("n"), F.sum("o").alias("o")).where((F.greatest("n", "o") > hot) & (F.least("n", "o") > 0))
    split = counts.select(*cell, F.ceil(F.col("n") / hot).cast("int").alias("left_parts"), F.ceil(F.col("o") / hot).cast("int").alias("right_parts"))
    split = kept(split, "hot")
    few = split.count()
    if few:
        split = F.broadcast(split) if few <= FEW else split

        def salted(table: DataFrame, mine: str, its: str, other: str, other_its: str) -> DataFrame:
            found = table.join(split, cell, "left").fillna(1, ["left_parts", "right_parts"])
            found = found.withColumn(its, F.pmod(F.xxhash64("a", "b", F.to_json("row")), F.col(mine)).cast("int"))
            return found.withColumn(other_its, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("left_parts", "right_parts")

        one, two = salted(one, "left_parts", "s", "right_parts", "t"), salted(two, "right_parts", "t", "left_parts", "s")
        cell = [*cell, "s", "t"]
    x, y = one.alias("x"), two.alias("y")
    same = F.lit(True)
    for c in cell:
        same = same & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    begins = bin_of(F.greatest("x.a", "y.a"), F.col("x.m"), width) == F.col("x.bin")
    pairs = x.join(y, same & (F.col("x.a") <= F.col("y.b")) & (F.col("y.a") <= F.col("x.b")) & begins)
    mine = [F.col("x.row").getField(c).alias(c) for c in left.columns]
    return pairs.select(*mine, *[F.col("y.row").getField(c).alias(prefix + c) for c in right.columns])
