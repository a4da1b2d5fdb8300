"""Tiled whitening against one matrix."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("tarnfold.llm")

from tarnfold.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component int"


def data(n, d, seed):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.4 + rng.normal(size=d)).astype(np.float32)


@pytest.mark.parametrize(("tile", "most"), [(0, 32), (3, 5), (7, 40)])
def test_tiles_are_the_whole_matrix(spark, monkeypatch, tile, most):
    monkeypatch.setattr(whitening, "ROWS", 50)
    monkeypatch.setattr(whitening, "GROUP", 3)
    vectors = data(700, 17, 1)
    df = spark.createDataFrame([(i, v.tolist(), "x", 9) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    got = whitening.whiten(df, most=most, tile=tile).toPandas().sort_values(["vec_id", "component"])
    k = min(most, 17)
    assert len(got) == 700 * k and (got.n == 700).all()
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1000000
    z = 700 * x - x.sum(axis=0)
    cov = (z / 700).T @ (z / 700) / 700
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    want = z / 700 @ directions / np.sqrt(values)
    own = got.whitened.to_numpy().reshape(700, k)
    own = own * np.sign((own * want).sum(axis=0))
    assert np.allclose(own, want, atol=1e-8) and np.allclose(got.explained.to_numpy()[:k], values / np.trace(cov), rtol=1e-9)
    assert (got.deviation.to_numpy().reshape(700, k)[:, 0] == (z * z).sum(axis=1)).all()
    spread = own.T @ own / 700 - np.outer(own.mean(axis=0), own.mean(axis=0))
    assert got.identity_error.iloc[0] < 1e-9 and abs(np.abs(spread - np.eye(k)).max() - got.identity_error.iloc[0]) < 1e-9


def test_odd_vectors(spark):
    rng = random.Random(2)
    vector = lambda: [rng.gauss(0, 1) for _ in range(4)]
    good = [(i, vector()) for i in range(50)] + [(None, vector()), (3, vector())]
    good += [good[0]] * 30
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [math.nan, 1.0, 1.0, 1.0]), (103, [math.inf, 1.0, 1.0, 1.0]), (104, []), (105, [1.0, 2.0]), (106, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 9) for i, v in good + bad], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * len(good) and {r.n for r in got} == {len(good)} and {r.vec_id for r in got} == {i for i, _ in good}
    assert got[0].identity_error < 1e-9 and abs(sum(r.explained for r in got) / len(good) - 1) < 1e-9
    assert whitening.whiten(df.where("vec_id >= 100").where("vec_id <= 104")).count() == 0 and whitening.whiten(df.limit(0)).count() == 0


def test_what_does_not_vary(spark):
    # Two dimensions are alike and a third is constant: one component varies.
    df = spark.createDataFrame([(i, [i / 8, i / 8, 5.0]) for i in range(20)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-9
    assert all(abs(r.explained - (r.component == 1)) < 1e-9 for r in got)
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")).collect()
    assert len(same) == 6 and all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in same)
    with pytest.raises(Exception, match="long"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>")).collect()


def test_narrow():
    for top, kind in ((127, "<i1"), (-129, "<i2"), (1 << 20, "<i4"), (1 << 40, "<i8")):
        got = whitening.narrow(np.array([[1, top]]))
        assert got[0] == kind and np.frombuffer(got[1], kind).tolist() == [1, top]
