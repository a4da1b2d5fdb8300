"""Sketches that are stored with each version of a table, and answer for any of them together without reading it.

For each column a version has the number of its rows and of its nulls, a sketch
of its distinct values and, if it is a number, one of its quantiles.  They are a
few kilobytes, whatever the table's size, are committed with it, and add up: a
question over the whole history reads as many sketches as there are versions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.compare import named

FOLDER = "_sketches"
#: Sizes: 2**12 registers for distinct values, and 200 items a level for quantiles.
LOG_K, QUANTILE_K = 12, 200
#: Greatest errors, of three standard errors: relative, of distinct counts, and of ranks.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LOG_K / 2), 0.0133 * 1.5
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
SCHEMA = "name string, n long, nulls long, distinct binary, quantiles binary"


def sketchable(kind: T.DataType) -> bool:
    return isinstance(kind, (*NUMBERS, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType))


def sketches_of(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each column, by default all that have values to count: ``name``, ``n``, ``nulls``, ``distinct`` and ``quantiles``.

    Values are told apart as text but for whole numbers, which are those of any
    width, so that columns that became longs later count along with them.  NaN is
    a value, but has no rank.
    """
    columns = [f.name for f in df.schema.fields if sketchable(f.dataType)] if columns is None else list(columns)
    every = []
    for i, name in enumerate(columns):
        kind, c = df.schema[name].dataType, named(name)
        whole = isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType)
        value = c.cast("long") if whole else F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")
        every += [F.count(c).alias(f"n{i}"), F.count_if(c.isNull()).alias(f"z{i}"), F.hll_sketch_agg(value, F.lit(LOG_K)).alias(f"d{i}")]
        if isinstance(kind, NUMBERS):
            number = c.cast("double")
            every.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(QUANTILE_K)).alias(f"q{i}"))
        else:
            every.append(F.lit(None).cast("binary").alias(f"q{i}"))
    rows = [F.struct(F.lit(name).alias("name"), F.col(f"n{i}").alias("n"), F.col(f"z{i}").alias("nulls"), F.col(f"d{i}").alias("distinct"), F.col(f"q{i}").alias("quantiles")) for i, name in enumerate(columns)]
    if not rows:
        return df.sparkSession.createDataFrame([], SCHEMA)
    return df.agg(*every).select(F.inline(F.array(*rows)))


def write_sketches(df: DataFrame, folder: str, columns: Sequence[str] | None = None) -> None:
    """Write a table's sketches beside it."""
    sketches_of(df, columns).coalesce(1).write.parquet(f"{folder}/{FOLDER}")


def read_sketches(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """The sketches in some versions' folders."""
    paths = [f"{f}/{FOLDER}" for f in folders]
    return spark.read.schema(SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)


def together(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What sketches of some versions say together, by column ``name``.

    ``n`` and ``nulls`` are exact.  ``n_distinct`` is within ``DISTINCT_ERROR`` of
    the number of different values, and each of ``quantiles`` has a rank within
    ``RANK_ERROR`` of what was asked; both hold for 99 cases of 100 or more.
    Columns that are no numbers, or have none, have null ``quantiles``.
    """
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    # An empty sketch has no quantiles, and adds nothing.
    merged = sketches.groupBy("name").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double("quantiles").alias("merged"),
    )
    some = F.when(F.col("merged").isNotNull(), F.kll_sketch_get_n_double("merged")).otherwise(0) > 0
    return merged.select("name", "n", "nulls", "n_distinct", F.when(some, F.kll_sketch_get_quantile_double("merged", asked)).alias("quantiles"))
