"""Sketches of versions against exact counts of their rows."""

import math
import random
from datetime import datetime

import pytest

from tarnfold.sources import sketches, store


def test_history_by_sketches(spark, tmp_path):
    rng = random.Random(4)
    root, every = f"file://{tmp_path}/s", []
    for day in range(1, 5):
        rows = [(rng.randrange(30_000), rng.choice([None, math.nan, rng.gauss(0, 10)]), f"w{rng.randrange(400 * day)}", [1]) for _ in range(9000)]
        every.append(rows)
        store.publish(spark.createDataFrame(rows, "i int, `d.x` double, s string, a array<int>"), root, datetime(2024, 1, day), sketches=True)
    for first, until in ((1, None), (2, 3), (4, 4)):
        own = [r for rows in every[first - 1 : until] for r in rows]
        got = {r["name"]: r for r in store.summary(spark, root, first, until, (0.1, 0.5, 0.99)).collect()}
        assert set(got) == {"i", "d.x", "s"}
        for k, name in enumerate(("i", "d.x", "s")):
            values = [r[k] for r in own if r[k] is not None]
            assert (got[name].n, got[name].nulls) == (len(values), len(own) - len(values))
            distinct = len({repr(v) for v in values})
            assert abs(got[name].n_distinct - distinct) <= sketches.DISTINCT_ERROR * distinct
            if name != "s":
                ranked = sorted(v for v in values if not math.isnan(v))
                for q, v in zip((0.1, 0.5, 0.99), got[name].quantiles, strict=True):
                    low, high = sum(x < v for x in ranked) / len(ranked), sum(x <= v for x in ranked) / len(ranked)
                    assert low - sketches.RANK_ERROR <= q <= high + sketches.RANK_ERROR
        assert got["s"].quantiles is None
    # The tables are as they were, and the summaries read nothing of them.
    assert store.read_history(spark, root).count() == 36_000 and store.read_latest(spark, root).columns == ["i", "d.x", "s", "a"]
    files = store.summary(spark, root)._jdf.inputFiles()
    assert files and all("/_sketches/" in f for f in files)


def test_sketches_of_odd_versions(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    store.publish(spark.createDataFrame([], "i int, s string"), root, datetime(2024, 1, 1), sketches=["i"])
    store.publish(spark.createDataFrame([(7,), (None,), (7,)], "i long"), root, datetime(2024, 1, 2), sketches=True)
    store.publish(spark.createDataFrame([(7,)], "i int"), root, datetime(2024, 1, 3), sketches=True)
    assert [tuple(r) for r in store.summary(spark, root, quantiles=[0.5]).collect()] == [("i", 3, 1, 1, [7.0])]
    assert [tuple(r) for r in store.summary(spark, root, until=1, quantiles=[0.5]).collect()] == [("i", 0, 0, 0, None)]
    assert store.summary(spark, root, first=9).count() == 0
    store.publish(spark.createDataFrame([(8,)], "i int"), root, datetime(2024, 1, 4))
    with pytest.raises(ValueError, match="4"):
        store.summary(spark, root)
