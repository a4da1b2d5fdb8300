"""As-of and interval joins against plain loops, with ties, hot keys, nulls and odd names."""

import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tarnfold.operators import ranges
from tarnfold.operators.asof import asof_join
from tarnfold.operators.ranges import overlap_join
from tarnfold.operators.theta import inequality_join, inequality_totals


def plain_asof(left, right, direction, strict, tolerance):
    out = []
    for key, t, own in left:
        best = None
        for k, u, v in right:
            if None in (key, t, k, u) or k != key or (u > t if direction == "backward" else u < t) or strict and u == t or tolerance is not None and abs(t - u) > tolerance:
                continue
            rank = (u if direction == "backward" else -u, v is not None, v)
            if best is None or rank > best[0]:
                best = (rank, (k, u, v))
        out.append((key, t, own, *(best[1] if best else (None, None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("direction", "strict", "tolerance", "parts"), [("backward", False, None, 7), ("backward", True, 5, 3), ("forward", False, 3, 40), ("forward", True, None, 1)])
def test_asof_is_the_plain_loop(spark, direction, strict, tolerance, parts):
    # Key 0 has most rows, key 1 one instant only; 2 has no right rows, 3 no left ones.
    rng = random.Random(parts)
    key = lambda n: rng.choice([0] * n + [1, 2, 4, 5, None])
    left = [(k, 50 if k == 1 else rng.choice([rng.randrange(200), 77, None]), i) for i in range(300) for k in [key(9)]] + [(0, 77, 1)] * 3
    right = [(k, 50 if k == 1 else rng.choice([rng.randrange(200), 77]), rng.choice([i, 3, None])) for i in range(80) for k in [rng.choice([0, 0, 0, 1, 3, 4, None])]]
    right += [(5, 10, 1), (0, None, 5)]
    a = spark.createDataFrame(left, "k int, `t.x` int, v int").repartition(3)
    b = spark.createDataFrame(right, "k int, u int, v int").repartition(2)
    limit = None if tolerance is None else F.lit(tolerance)
    got = asof_join(a, b, "t.x", "u", on=["k"], direction=direction, strict=strict, tolerance=limit, parts=parts)
    assert got.columns == ["k", "t.x", "v", "right_k", "right_u", "right_v"]
    want = plain_asof(left, right, direction, strict, tolerance)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    inner = asof_join(a, b, "t.x", "u", on=["k"], direction=direction, strict=strict, tolerance=limit, parts=parts, how="inner")
    assert sorted(map(tuple, inner.collect()), key=repr) == [r for r in want if r[4] is not None]


def test_asof_carries_over_whole_partitions(spark):
    # One right row, then a key whose rows fill many partitions, in batches of three rows.
    left = spark.range(1, 1000).selectExpr("id AS t", "'x' AS k")
    right = spark.createDataFrame([(0, "x", [1]), (990, "x", None), (0, "y", [3])], "u long, k string, v array<int>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = asof_join(left, right, "t", "u", on=["k"], parts=50).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.t, r.right_u) for r in got) == [(t, 0 if t < 990 else 990) for t in range(1, 1000)]


def test_asof_types_and_empty_tables(spark):
    left = spark.createDataFrame([(math.nan, datetime(2024, 1, 2), "a"), (1.0, datetime(2024, 1, 3), "b")], "k double, t timestamp_ntz, l string")
    right = spark.createDataFrame([(math.nan, datetime(2024, 1, 1), {"m": 1}), (1.0, datetime(2024, 1, 1), None)], "k double, t timestamp_ntz, m map<string,int>")
    got = {r.l: r for r in asof_join(left, right, "t", "t", on=["k"], tolerance=F.expr("INTERVAL 1 DAY")).collect()}
    assert got["a"].right_m == {"m": 1} and got["b"].right_t is None
    assert asof_join(left.limit(0), right, "t", "t").count() == 0 and asof_join(left, right.limit(0), "t", "t").count() == 2
    assert asof_join(left, right.limit(0), "t", "t", how="inner").count() == 0
    with pytest.raises(ValueError, match="direction"):
        asof_join(left, right, "t", "t", direction="nearest")


def plain_overlaps(left, right):
    fine = lambda k, a, b: None not in (k, a, b) and a <= b and abs(a) < math.inf and abs(b) < math.inf
    return sorted(((*x, *y) for x in left if fine(*x[:3]) for y in right if fine(*y[:3]) and x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]), key=repr)


@pytest.mark.parametrize(("kind", "width", "hot"), [("long", None, 1 << 16), ("long", 1, 4), ("double", None, 6), ("double", 0.5, 1 << 16)])
def test_overlaps_are_the_plain_pairs(spark, kind, width, hot):
    rng = random.Random(kind + str(width))
    number = (lambda x: int(x)) if kind == "long" else float

    def span():
        a = rng.uniform(-500, 500)
        return number(a), number(a + rng.choice([0, 0, 1, 3, rng.expovariate(0.01), 900, -1]))

    table = lambda n: [(rng.choice([0, 0, 0, 1, 2, None]), *span(), i) for i in range(n)] + [(0, number(7), number(7), -1)] * 12 + [(0, None, number(3), -2), (1, number(2), None, -3)]
    left, right = table(150), table(130)
    if kind == "double":
        left += [(0, math.nan, 5.0, 1), (0, 1.0, math.inf, 2)]
    schema = f"k int, a {kind}, `b.x` {kind}, bin int"
    x, y = spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema).repartition(2)
    got = overlap_join(x, y, ("a", "b.x"), ("a", "b.x"), on=["k"], width=width, hot=hot)
    assert got.columns == ["k", "a", "b.x", "bin", "right_k", "right_a", "right_b.x", "right_bin"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_overlaps(left, right)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlaps_of_times(spark):
    one = spark.createDataFrame([(datetime(2024, 3, 31, 1, 59, 59, 999999), datetime(2024, 3, 31, 2, 30)), (None, None)], "a timestamp_ntz, b timestamp_ntz")
    two = spark.createDataFrame([(date(2024, 3, 31),), (date(2024, 4, 1),), (None,)], "d date")
    three = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30),), (datetime(2024, 3, 31, 2, 30, 0, 1),)], "p timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert overlap_join(one, three, ("a", "b"), ("p", "p")).count() == 1
        assert overlap_join(two, two, ("d", "d"), ("d", "d")).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert overlap_join(one.limit(0), three, ("a", "b"), ("p", "p")).count() == 0
    with pytest.raises(TypeError, match="string"):
        overlap_join(one, spark.createDataFrame([("x",)], "s string"), ("a", "b"), ("s", "s"))


def test_position_orders_microseconds(spark):
    rows = [datetime(1600, 1, 1, 0, 0, 0, 1), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), datetime(2024, 2, 29, 12, 0, 1, 5)]
    df = spark.createDataFrame([(r,) for r in rows], "t timestamp_ntz")
    got = [r.p for r in df.select(ranges.position(df, "t").alias("p")).collect()]
    assert got == [(r - datetime(1970, 1, 1)) // (datetime.resolution) for r in rows]


@pytest.mark.parametrize(("first", "second", "bits"), [("<", ">=", 3), (">", ">", 5), ("<=", "<", 0), (">=", None, 2), ("<", None, None)])
def test_inequalities_are_the_plain_pairs(spark, first, second, bits):
    rng = random.Random(first)
    ops = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
    table = lambda n: [(rng.choice([rng.randrange(40), 7, None]), rng.choice(["a", "b", f"k{rng.randrange(30)}", None]), i) for i in range(n)] + [(7, "b", 5)] * 10
    left, right = table(90), table(70)
    x = spark.createDataFrame(left, "n int, `s.t` string, row int").repartition(3)
    y = spark.createDataFrame(right, "n int, `s.t` string, row int")
    conditions = [("n", first, "n")] + [("s.t", second, "s.t")] * (second is not None)
    got = inequality_join(x, y, conditions, bits=bits)
    assert got.columns == ["n", "s.t", "row", "right_n", "right_s.t", "right_row"]

    def fits(a, b):
        return all(None not in (a[i], b[i]) and ops[op](a[i], b[i]) for i, op in ((0, first), (1, second)) if op)

    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*a, *b) for a in left for b in right if fits(a, b)), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert inequality_join(x.limit(0), y, conditions).count() == 0


@pytest.mark.parametrize(("first", "second", "stretch"), [("<", ">=", 15), (">", ">", 3), ("<=", "<", 1), (">=", None, 15), ("<", None, 2), ("<=", ">=", 4)])
def test_totals_are_those_of_the_plain_pairs(spark, first, second, stretch):
    rng = random.Random(f"{first}{second}")
    ops = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
    table = lambda n: [(rng.choice([rng.randrange(40), 7, None]), rng.choice(["a", "b", f"k{rng.randrange(30)}", None]), rng.choice([rng.randrange(-9, 9), None])) for _ in range(n)] + [(7, "b", 5)] * 10
    left, right = table(90), table(170)
    x = spark.createDataFrame(left, "n int, `s.t` string, row int").repartition(3)
    y = spark.createDataFrame(right, "n int, `s.t` string, row int")
    conditions = [("n", first, "n")] + [("s.t", second, "s.t")] * (second is not None)
    got = inequality_totals(x, y, conditions, {"total": "row"}, stretch=stretch)
    assert got.columns == ["n", "s.t", "row", "n", "total"]

    def fits(a, b):
        return all(None not in (a[i], b[i]) and ops[op](a[i], b[i]) for i, op in ((0, first), (1, second)) if op)

    want = []
    for a in left:
        found = [b[2] for b in right if fits(a, b)]
        known = [v for v in found if v is not None]
        want += [(*a, len(found), sum(known) if known else None)] * bool(found)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert inequality_totals(x.limit(0), y, conditions, {}).count() == 0 and inequality_totals(x, y.limit(0), conditions, {}).count() == 0


def test_totals_make_no_pairs(spark):
    # 20,000 x 20,000 rows have 2 x 10**8 pairs by one inequality, and about 10**8 by both.
    x = spark.range(20_000).selectExpr("id AS a", "id * 7919 % 20011 AS b")
    got = inequality_totals(x, x, [("a", ">=", "a"), ("b", "<", "b")], {"s": "a"}, "pairs", stretch=8).orderBy("a").toPandas()
    b = x.toPandas()["b"].to_numpy()
    for i in (0, 1, 77, 4096, 19_999):
        above = (b[: i + 1] > b[i]).nonzero()[0]
        row = got[got["a"] == i]
        assert (int(row["pairs"].iloc[0]), int(row["s"].iloc[0])) == (len(above), above.sum()) if len(above) else row.empty


def test_inequalities_meet_once():
    # Of any two ranks there is one node at which they meet, and of one rank with itself the range.
    def own(rank, bits, lesser):
        return {(b, rank >> (b + 1)) for b in range(bits) if (rank >> b & 1) == (0 if lesser else 1)} | {(-1, rank)}

    for a in range(32):
        for b in range(32):
            met = own(a, 5, True) & own(b, 5, False)
            assert len(met) == (a <= b) and (a != b or met == {(-1, a)})
