"""A table function for SQL: runs of a key's rows without a gap in time."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn


def column(table: T.StructType, name: str) -> T.StructField:
    """A column of a table by its name, which SQL may write in any case."""
    found = [f for f in table.fields if f.name.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"the table has no one column {name}: it has {', '.join(table.names)}")
    return found[0]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Islands:
    """``islands(TABLE(t), keys, time, gap)``: the islands of each key of a table.

    ``keys`` names key columns, with commas between them, or is empty; ``time`` a
    column of numbers, dates or times; ``gap`` is the longest distance between
    neighbours of one island: a number, or an interval for times.  A row for each
    island: the keys, of the table's own types, ``island`` from 1 in the order of
    time, ``first`` and ``last`` of the time's type, ``n_rows``, and ``gap``, from
    the end of the island before, null for the first.

    The function asks for its table by key and in order of time, and of that for
    the columns that it needs only; it holds one island.  Rows of null time are
    in no island.  Null keys are a key.  All of a key's rows go through one task.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, keys: AnalyzeArgument, time: AnalyzeArgument, gap: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or not isinstance(keys.value, str) or not isinstance(time.value, str):
            raise ValueError("islands(TABLE(t), keys, time, gap) takes a table and the names of columns")
        own = [column(table.dataType, k.strip()) for k in keys.value.split(",") if k.strip()]
        at = column(table.dataType, time.value)
        distance = gap.dataType if isinstance(at.dataType, T.TimestampType | T.TimestampNTZType) else at.dataType
        if isinstance(at.dataType, T.TimestampType | T.TimestampNTZType) != isinstance(gap.dataType, T.DayTimeIntervalType):
            raise ValueError("times take a gap that is an interval, numbers and dates one that is a number")
        if isinstance(at.dataType, T.DateType):
            distance = T.IntegerType()
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in own])
        schema = schema.add("island", T.LongType()).add("first", at.dataType).add("last", at.dataType).add("n_rows", T.LongType())
        schema = schema.add("gap", T.DayTimeIntervalType() if isinstance(distance, T.DayTimeIntervalType) else distance)
        names = [quoted(f.name) for f in [*own, at]]
        return AnalyzeResult(
            schema=schema,
            withSinglePartition=not own,
            partitionBy=[PartitioningColumn(n) for n in names[:-1]],
            orderBy=[OrderingColumn(names[-1])],
            select=[SelectedColumn(n) for n in dict.fromkeys(names)],
        )

    def __init__(self) -> None:
        self.number = self.count = 0
        self.key = self.first = self.last = self.before = None

    def eval(self, table: Row, keys: str, time: str, gap) -> Iterator[tuple]:
        names = {n.lower(): n for n in table.__fields__}
        at = table[names[time.lower()]]
        if at is None:
            return
        if self.last is not None:
            distance = at - self.last
            if (distance.days if hasattr(distance, "days") and not hasattr(gap, "days") else distance) > gap:
                yield self.closed()
        if not self.count:
            self.key = tuple(table[names[k.strip().lower()]] for k in keys.split(",") if k.strip())
            self.first = at
        self.last = at
        self.count += 1
        self.whole_days = not hasattr(gap, "days")

    def closed(self) -> tuple:
        """The island that ends here."""
        self.number += 1
        distance = None if self.before is None else self.first - self.before
        if hasattr(distance, "days") and self.whole_days:
            distance = distance.days
        out = (*self.key, self.number, self.first, self.last, self.count, distance)
        self.before, self.last, self.count = self.last, None, 0
        return out

    def terminate(self) -> Iterator[tuple]:
        if self.count:
            yield self.closed()


def register(spark: SparkSession) -> None:
    """Make ``islands`` known to a session's SQL."""
    spark.udtf.register("islands", udtf(Islands, useArrow=True))
