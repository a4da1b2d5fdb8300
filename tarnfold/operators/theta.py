"""Theta join: pairs of rows by two inequalities, without looking at pairs that don't fit.

Rows of both tables are ranked on each of the two columns by range partitions,
and a rank's bits say where two rows part: of two different ranks the highest bit
in which they differ tells which is less, and the bits above it are common.  So
every row is sent, for each bit, to the node of the bits above; the lesser side
of a pair goes there if the bit is 0, and the greater if it is 1, and each pair
meets at one node.  Nodes of both columns together are the keys of one equal
join, whose every match is a result.  Only rows that share a range are compared.

Where only counts and sums over a row's matches are asked for, no pair is made:
rows are numbered in the order of one column, each right row lies in a block of
each size, the blocks before a left row make up all that fits it there, and in
each of them a running sum in the order of the other column gives what fits both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_folder
from .compare import named

#: Rows of a range that are compared with each other, and bits of a rank at most.
SHARE, BITS = 1024, 12
#: Bits by which a block of numbered rows is wider than one of the size below, and bits of the numbers of one running sum.
WIDER, STRETCH = 3, 15
LESS = ("<", "<=")
MORE = (">", ">=")


def ranked(table: DataFrame, column: str, bits: int, path: str) -> DataFrame:
    """The table with the range of each row on a column, ``rank_<column>``, of about 2**bits; equal values share one."""
    # The shuffle's own sample cuts the ranges; they are kept in the files, whatever reads these.
    dealt = table.repartitionByRange(1 << bits, F.col(column)).withColumn(f"rank_{column}", F.spark_partition_id())
    dealt.write.parquet(path)
    return table.sparkSession.read.schema(dealt.schema).parquet(path)


def nodes(rank: Column, bits: int, lesser: bool) -> Column:
    """Where a row may meet others on one column: the nodes at which it is the lesser or the greater, and its range.

    A node is the number of bits below and the bits above; the range itself is
    -1 and all bits.
    """
    own = [F.when(F.shiftright(rank, b).bitwiseAND(F.lit(1)) == F.lit(0 if lesser else 1), F.struct(F.lit(b).alias("bit"), F.shiftright(rank, b + 1).alias("above"))) for b in range(bits)]
    return F.filter(F.array(*own, F.struct(F.lit(-1).alias("bit"), rank.alias("above"))), lambda n: n.isNotNull())


def holds(left: Column, op: str, right: Column) -> Column:
    return {"<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[op]


def inequality_join(left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str, str]], prefix: str = "right_", bits: int | None = None) -> DataFrame:
    """All pairs of a ``left`` and a ``right`` row for which one or two conditions hold.

    A condition is a column of ``left``, one of ``< <= > >=``, and a column of
    ``right`` of the same type.  Columns of ``right`` come under ``prefix``.

    Nulls match nothing; NaN is above all numbers and like itself, as Spark
    orders them.  Ties hold for ``<=`` and ``>=``.  Repeated rows make pairs each.

    A row is sent to about ``bits``/2 + 1 nodes for each condition, that is to at
    most 49 for two with 12 bits, and each match is a pair that holds, but among
    rows that share a range of a column: 2**bits ranges are chosen so that about
    ``SHARE`` rows do, or, with more than that much data, a 4096th of them.  A
    node with very many rows of both sides has as many pairs to give as their
    product, and is split by the adaptive skew join.
    """
    if not 1 <= len(conditions) <= 2 or any(op not in LESS + MORE for _, op, _ in conditions):
        raise ValueError("one or two conditions with <, <=, > or >= are joined")
    spark = left.sparkSession
    path = shared_folder(spark, "theta")
    sides = []
    for table, place in ((left, 0), (right, 2)):
        columns = [named(c[place]).alias(f"c{i}") for i, c in enumerate(conditions)]
        rows = table.select(F.lit(place == 0).alias("is_left"), F.struct(*[named(c).alias(c) for c in table.columns]).alias("row"), *columns)
        for i in range(len(conditions)):
            rows = rows.where(F.col(f"c{i}").isNotNull())
        sides.append(rows)
    # Ranges are of both tables together.
    empty = [F.lit(None).cast(s.schema["row"].dataType).alias(n) for s, n in zip(sides, ("l", "r"), strict=True)]
    values = [f"c{i}" for i in range(len(conditions))]
    both = sides[0].select("is_left", F.col("row").alias("l"), empty[1], *values).unionByName(sides[1].select("is_left", empty[0], F.col("row").alias("r"), *values))
    if bits is None:
        bits = min(BITS, max(0, (both.count() // SHARE).bit_length()))
    for i, c in enumerate(values):
        both = ranked(both, c, bits, f"{path}/{i}")
    tops = both.agg(*[F.max(f"rank_{c}") for c in values]).first()
    for i, (_, op, _) in enumerate(conditions):
        rank, own_bits = F.col(f"rank_c{i}"), (tops[i] or 0).bit_length()
        lesser = F.col("is_left") if op in LESS else ~F.col("is_left")
        both = both.withColumn(f"node{i}", F.when(lesser, nodes(rank, own_bits, True)).otherwise(nodes(rank, own_bits, False)))
        both = both.withColumn(f"node{i}", F.explode(f"node{i}"))
    x, y = both.where("is_left").alias("x"), both.where("NOT is_left").alias("y")
    on = F.lit(True)
    for i, (_, op, _) in enumerate(conditions):
        node = F.col(f"x.node{i}")
        on = on & (node == F.col(f"y.node{i}")) & ((node["bit"] >= 0) | holds(F.col(f"x.c{i}"), op, F.col(f"y.c{i}")))
    pairs = x.join(y, on)
    mine = [F.col("x.l").getField(c).alias(c) for c in left.columns]
    return pairs.select(*mine, *[F.col("y.r").getField(c).alias(prefix + c) for c in right.columns])


def numbered(table: DataFrame, order: Sequence[Column], name: str, path: str) -> DataFrame:
    """The table with the place of each row in an order, from 0, without a task that has all of it."""
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = table.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # This id is the partition and the row's place there; both are kept in the files, whatever reads these.
    dealt = dealt.withColumn("__id", F.monotonically_increasing_id()).withColumns({"__part": F.shiftright("__id", 33), "__place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id")
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)
    # One row a partition.
    before = kept.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return kept.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__place")).drop("__part", "__place", "__before")


def inequality_totals(left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str, str]], sums: Mapping[str, str], count: str = "n", stretch: int = STRETCH) -> DataFrame:
    """Each ``left`` row that has a match, with the number of its matches and sums of columns of ``right`` over them.

    These are what ``inequality_join``, grouped by left rows, gives, by the same
    conditions: nulls match nothing, NaN is above all numbers, ties hold for
    ``<=`` and ``>=``, and repeated rows count each.  ``sums`` names results and
    columns of ``right``; nulls are left out, and a sum of nothing else is null.
    Intervals that share a point are two conditions: the one's start and the
    other's end, both ways.

    Time grows as n log n, and not with the pairs: different values of the
    conditions' columns are numbered, a right one has a row for each size of
    block and a left one at most 7 for each.  A running sum is over at most
    2**``stretch`` of these, and what comes before is added to it.
    """
    if not 1 <= len(conditions) <= 2 or any(op not in LESS + MORE for _, op, _ in conditions):
        raise ValueError("one or two conditions with <, <=, > or >= are joined")
    spark = left.sparkSession
    path = shared_folder(spark, "totals")
    values = [f"v{i}" for i in range(len(sums))]
    points = [f"c{i}" for i in range(len(conditions))]

    def usable(table: DataFrame, place: int, extra: Sequence[Column]) -> DataFrame:
        out = table.select(*[named(c[place]).alias(p) for c, p in zip(conditions, points, strict=True)], *extra)
        return out.where(F.expr(" AND ".join(f"{p} IS NOT NULL" for p in points)))

    own = usable(right, 2, [named(c).alias(v) for c, v in zip(sums.values(), values, strict=True)])
    own = own.groupBy(*points).agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in values])
    kinds = dict(own.dtypes)
    asked = usable(left, 0, []).distinct()
    both = own.select(F.lit(False).alias("is_left"), *points, "n", *values).unionByName(asked.select(F.lit(True).alias("is_left"), *points, F.lit(None).cast("long").alias("n"), *[F.lit(None).cast(kinds[v]).alias(v) for v in values]))
    # In each order the right rows that fit a left one are those before it.
    for i in reversed(range(len(conditions))):
        op = conditions[i][1]
        at = F.col(f"c{i}").asc() if op in MORE else F.col(f"c{i}").desc()
        first = F.col("is_left").asc() if op in ("<=", ">=") else F.col("is_left").desc()
        both = numbered(both, [at, first, *points], f"r{i}", f"{path}/{i}")
        if len(conditions) == 1:
            both = both.withColumn("r1", F.col("r0"))
    both.write.parquet(f"{path}/both")
    both = spark.read.schema(both.schema).parquet(f"{path}/both")
    levels = -(-max(1, (both.count() - 1).bit_length()) // WIDER)
    digit = (1 << WIDER) - 1
    block = lambda level: F.struct(level.cast("int").alias("level"), F.call_function("shiftright", F.col("r1"), level * WIDER).alias("block"))
    sizes = F.sequence(F.lit(0), F.lit(levels - 1))
    lies = F.transform(sizes, block)
    # The last block of its parent is before no other one there.
    lies = F.filter(lies, lambda b: b["block"].bitwiseAND(F.lit(digit)) < digit)

    def before(b: Column) -> Column:
        place = b["block"].bitwiseAND(F.lit(digit))
        some = F.transform(F.sequence(F.lit(1), F.greatest(place.cast("int"), F.lit(1))), lambda d: F.struct(b["level"].alias("level"), (b["block"] - d).alias("block")))
        return F.filter(some, lambda _: place > 0)

    looks = F.flatten(F.transform(F.transform(sizes, block), before))
    rows = both.select("is_left", "r0", "r1", "n", *values, F.explode(F.when(F.col("is_left"), looks).otherwise(lies)).alias("in")).select("*", "in.*").drop("in")
    # A block of few rows is one stretch.
    rows = rows.withColumn("stretch", F.when(F.col("level") * WIDER > stretch, F.shiftright("r0", stretch)).otherwise(F.lit(0).cast("long")))
    cell = ["level", "block", "stretch"]
    until = Window.partitionBy(*cell).orderBy("r0").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.select(*cell, "is_left", "r1", *[F.sum(v).over(until).alias(v) for v in ("n", *values)]).where("is_left")
    # Read three times.
    seen.write.parquet(f"{path}/seen")
    seen = spark.read.schema(seen.schema).parquet(f"{path}/seen")
    parts = [seen.select("r1", "n", *values)]
    if levels - 1 > stretch // WIDER:
        large = rows.where((F.col("level") * WIDER > stretch) & ~F.col("is_left")).groupBy(*cell).agg(*[F.sum(v).alias(v) for v in ("n", *values)])
        # A left row asks for what its block's stretches before its own come to, whether its own has right rows or not.
        marks = seen.where(F.col("level") * WIDER > stretch).select(*cell).distinct()
        none = [F.lit(None).cast(kinds[v]).alias(v) for v in ("n", *values)]
        earlier = Window.partitionBy("level", "block").orderBy("stretch").rangeBetween(Window.unboundedPreceding, -1)
        ahead = large.unionByName(marks.select(*cell, *none)).groupBy(*cell).agg(*[F.sum(v).alias(v) for v in ("n", *values)])
        ahead = ahead.select(*cell, *[F.sum(v).over(earlier).alias(v) for v in ("n", *values)]).where("n > 0")
        parts.append(seen.select(*cell, "r1").join(ahead, cell).select("r1", "n", *values))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    found = found.groupBy("r1").agg(*[F.sum(v).cast(kinds[v]).alias(v) for v in ("n", *values)]).where("n > 0")
    totals = both.where("is_left").select("r1", *points).join(found, "r1").select(*[F.col(p).alias(f"__{p}") for p in points], F.col("n").alias("__n"), *[F.col(v).alias(f"__{v}") for v in values])
    same = F.lit(True)
    for c, p in zip(conditions, points, strict=True):
        same = same & (named(c[0]) == F.col(f"__{p}"))
    return left.join(totals, same).select(*[named(c) for c in left.columns], F.col("__n").alias(count), *[F.col(f"__{v}").alias(n) for n, v in zip(sums, values, strict=True)])
