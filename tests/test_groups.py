"""Window frames over hot keys and first rows of groups, against plain loops and the whole key's window."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnfold.operators.frames import rolling, running
from tarnfold.operators.ranges import position
from tarnfold.operators.topk import top_k


def events(spark, rng, n, kind):
    start = datetime(2024, 1, 1)
    at = (lambda s: start + timedelta(seconds=s)) if kind == "timestamp_ntz" else (lambda s: s if kind == "long" else s / 3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), at(rng.choice([rng.randrange(-900, 900), 5])) if rng.random() < 0.95 else None, rng.choice([rng.randrange(-50, 50), None]), i) for i in range(n)]
    rows += rows[:5]
    return spark.createDataFrame(rows, f"k string, `t.x` {kind}, v long, _id int").repartition(3)


@pytest.mark.parametrize(("kind", "before", "after", "per_key"), [("long", 40, 0, 20), ("timestamp_ntz", timedelta(seconds=30), timedelta(seconds=7), 11), ("double", 3, 1, 30), ("long", 10_000, 0, 5), ("long", 0, 0, 1 << 17)])
def test_rolling_is_the_whole_window(spark, kind, before, after, per_key):
    df = events(spark, random.Random(kind), 260, kind)
    aggregates = {"s": F.sum("v"), "n": F.count("v"), "m": F.min("v"), "all": F.count(F.lit(1))}
    got = rolling(df, ["k"], "t.x", before, aggregates, after, per_key)
    micros = lambda x: x // timedelta(microseconds=1) if isinstance(x, timedelta) else x
    frame = Window.partitionBy("k").orderBy("p").rangeBetween(-micros(before), micros(after))
    want = df.withColumn("p", position(df, "t.x")).select(*[F.col(f"`{c}`") for c in df.columns], *[c.over(frame).alias(n) for n, c in aggregates.items()])
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize(("kind", "before", "after"), [("long", 40, 0), ("long", 0, 25), ("timestamp_ntz", timedelta(seconds=30), timedelta(seconds=7)), ("double", 3, 1), ("long", 10_000, 1), ("long", 0, 0)])
def test_summed_frames_are_the_whole_window(spark, kind, before, after):
    df = events(spark, random.Random(kind), 260, kind).withColumn("d", F.col("v").cast("decimal(9,2)"))
    pairs = {"s": ("sum", "v"), "n": ("count", "v"), "m": ("min", "v"), "x": ("max", "v"), "all": ("count", "*"), "d_sum": ("sum", "d")}
    plain = {"s": F.sum("v"), "n": F.count("v"), "m": F.min("v"), "x": F.max("v"), "all": F.count(F.lit(1)), "d_sum": F.sum("d")}
    got, want = rolling(df, ["k"], "t.x", before, pairs, after), rolling(df, ["k"], "t.x", before, plain, after)
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert rolling(df.limit(0), ["k"], "t.x", before, pairs, after).count() == 0


def test_a_dense_frame_is_not_read_for_each_row(spark):
    df = spark.range(300_000).selectExpr("1 AS k", "id AS t", "id % 7 AS v")
    got = rolling(df, ["k"], "t", 200_000, {"s": ("sum", "v"), "n": ("count", "*")})
    # Each row reading its own frame, of up to 200,001 rows, makes 40 billion reads.
    assert got.agg(F.max("n")).first()[0] == 200_001
    assert "RangeFrame, -" not in got._jdf.queryExecution().toString()
    assert got.where("t = 299999").first().s == sum(i % 7 for i in range(99_999, 300_000))


def test_frames_reach_whole_numbers(spark):
    with pytest.raises(ValueError, match="whole"):
        rolling(spark.range(3).selectExpr("1 AS k", "id / 2 AS t"), ["k"], "t", 0.5, {"n": F.count(F.lit(1))})


def test_a_hot_key_is_cut(spark):
    df = spark.range(4000).selectExpr("'hot' AS k", "id AS t", "id % 7 AS v")
    # The rows that a stretch has, itself and its halo.
    seen = rolling(df, ["k"], "t", 10, {"n": F.count(F.lit(1))}, per_key=100)
    plan = seen._jdf.queryExecution().toString()
    assert "__in" in plan and seen.agg(F.max("n")).first()[0] == 11
    sizes = df.withColumn("_in", F.floor(F.col("t") / 100)).groupBy("_in").count().agg(F.max("count")).first()[0]
    assert sizes <= 100 and seen.count() == 4000


@pytest.mark.parametrize(("kind", "per_key"), [("long", 10), ("timestamp_ntz", 30), ("double", 1 << 17)])
def test_running_is_the_whole_window(spark, kind, per_key):
    df = events(spark, random.Random(kind), 260, kind)
    got = running(df, ["k"], "t.x", {f: (f, "v") for f in ("sum", "count", "min", "max")}, per_key)
    frame = Window.partitionBy("k").orderBy("`t.x`").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select(*[F.col(f"`{c}`") for c in df.columns], F.sum("v").over(frame).alias("sum"), F.count("v").over(frame).alias("count"), F.min("v").over(frame).alias("min"), F.max("v").over(frame).alias("max"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert running(df.limit(0), ["k"], "t.x", {"s": ("sum", "v")}).count() == 0 and rolling(df.limit(0), ["k"], "t.x", 1 if kind != "timestamp_ntz" else timedelta(1), {"s": F.sum("v")}).count() == 0


def plain_first(rows, key, order, k):
    groups = {}
    for r in rows:
        groups.setdefault(key(r), []).append(r)
    return sorted((x for own in groups.values() for x in sorted(own, key=order)[:k]), key=repr)


@pytest.mark.parametrize(("k", "most"), [(1, 1 << 16), (3, 8), (7, 1), (1000, 50)])
def test_top_k_is_the_plain_sort(spark, k, most):
    rng = random.Random(k)
    rows = [(rng.choice(["hot", "hot", "hot", f"g{rng.randrange(20)}", None]), rng.choice([1.5, math.nan, None, rng.random()]), rng.choice(["x", "y", None]), rng.random() < 0.5, i % 40, [i]) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, d double, `s.t` string, b boolean, row int, a array<int>").repartition(5)
    # Descending numbers, NaN first and null last, then strings with null first; the other columns ascending.
    number = lambda d: (2, 0) if d is None else (0, 0) if math.isnan(d) else (1, -d)
    string = lambda s: (s is not None, s or "")
    order = lambda r: (number(r[1]), string(r[2]), r[3], r[4])
    got = top_k(df, ["g"], [("d", "desc"), "s.t"], k, most=most)
    assert got.columns == df.columns
    alike = lambda rs: sorted(repr(tuple(r)[:5]) for r in rs)
    assert alike(got.collect()) == alike(plain_first(rows, lambda r: r[0], order, k))


def test_top_k_ranks_and_odd_tables(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (None, 1), (1, 7), (None, None)], "g int, v int")
    got = top_k(df, ["g"], [("v", "desc")], 2, rank="place")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 7, 1), (1, 7, 2), (None, 1, 1), (None, None, 2)], key=repr)
    assert sorted(map(tuple, top_k(df, [], ["v"], 2).collect()), key=repr) == sorted([(None, None), (None, 1)], key=repr)
    assert sorted(map(tuple, top_k(df, ["g", "v"], [], 1).collect()), key=repr) == sorted([(1, 5), (1, 7), (None, 1), (None, None)], key=repr)
    assert top_k(df.limit(0), ["g"], ["v"], 2).count() == 0
    with pytest.raises(ValueError, match="asc"):
        top_k(df, ["g"], [("v", "down")], 1)


@pytest.fixture(scope="module")
def sql(spark):
    from tarnfold.functions import islands

    islands.register(spark)
    return spark


def plain_islands(rows, gap):
    out = []
    for key in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == key and r[1] is not None)
        runs = []
        for t in times:
            if runs and t - runs[-1][-1] <= gap:
                runs[-1].append(t)
            else:
                runs.append([t])
        out += [(key, i + 1, r[0], r[-1], len(r), r[0] - runs[i - 1][-1] if i else None) for i, r in enumerate(runs)]
    return sorted(out, key=repr)


def test_islands_are_the_plain_runs(sql):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.randrange(300), None]), [i]) for i in range(120)] + [("c", None, [0])]
    df = sql.createDataFrame(rows, "`Key x` string, n int, other array<int>").repartition(4)
    got = sql.sql("SELECT * FROM islands(TABLE({t}), 'key x', 'N', 5)", t=df)
    assert got.columns == ["Key x", "island", "first", "last", "n_rows", "gap"] and got.schema["gap"].dataType.typeName() == "integer"
    assert sorted(map(tuple, got.collect()), key=repr) == plain_islands(rows, 5)
    alone = sql.sql("SELECT * FROM islands(TABLE({t}), '', 'n', 5)", t=df)
    assert sorted(map(tuple, alone.collect()), key=repr) == sorted((r[1:] for r in plain_islands([(0, *r[1:]) for r in rows], 5)), key=repr)
    assert sql.sql("SELECT * FROM islands(TABLE({t}), 'key x', 'n', 5)", t=df.limit(0)).count() == 0


def test_islands_of_times(sql):
    start = datetime(2024, 3, 1)
    rows = [(i // 6, start + timedelta(hours=x)) for i, x in enumerate([0, 1, 2, 30, 31, 90, 5, 5, 5, 29, 54, 1])]
    df = sql.createDataFrame(rows, "k int, t timestamp_ntz")
    got = sql.sql("SELECT * FROM islands(TABLE({t}), 'k', 't', INTERVAL '24' HOUR)", t=df)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_islands(rows, timedelta(hours=24))
    days = sql.sql("SELECT * FROM islands(TABLE({t}), 'k', 'd', 1)", t=df.selectExpr("k", "date(t) AS d"))
    want = plain_islands([(k, t.date()) for k, t in rows], timedelta(days=1))
    assert sorted(map(tuple, days.collect()), key=repr) == sorted(((*r[:5], r[5] and r[5].days) for r in want), key=repr)
    for bad in ("'k', 't', 5", "'none', 't', INTERVAL '1' HOUR", "'k', 'k', INTERVAL '1' HOUR"):
        with pytest.raises(Exception, match="take|has no one column"):
            sql.sql(f"SELECT * FROM islands(TABLE({{t}}), {bad})", t=df).collect()
