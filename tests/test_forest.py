"""The forest against a plain version grown row by row, over tops and in one task, whatever the partitioning."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import forest as FO
from tessera.operators import model as M

TREES = 8


def rows(n=600, classes=2, seed=5):
    r = np.random.default_rng(seed)
    x = np.stack([r.normal(size=n).round(1), r.integers(0, 4, n), r.integers(0, 20, n), np.ones(n), r.integers(0, 3, n)], axis=1)
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] > 2)) % classes
    flip = r.random(n) < .2
    y[flip] = r.integers(0, classes, flip.sum())
    return x, y


def frame(spark, x, y):
    df = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i int, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x"))


def scores(df):
    got = df.orderBy("i").select("i", vector_to_array("probability").alias("p"), "prediction").collect()
    return np.array([r.p for r in got]), [r.prediction for r in got]


def forest(**more):
    return M.random_forest("label", "features", TREES, 3, key=["i"], **more)


def plain(bins, y, w, k, m, min_leaf, depth, path):
    """Class shares of every row by one tree, node by node."""
    out = np.zeros((len(y), k))

    def impurity(at):
        c = np.bincount(y[at], w[at], k)
        return c.sum() - (c ** 2).sum() / max(c.sum(), 1e-300)

    def go(at, every, level, path):
        c = np.bincount(y[at], w[at], k)
        best = (1e-9, None)
        if level < depth and (c > 0).sum() > 1 and c.sum() >= 2 * min_leaf:
            for f in FO.drawn(path, bins.shape[1], m)[0]:
                for b in range(FO.MAX_BINS):
                    left = bins[at, f] <= b
                    if min(w[at[left]].sum(), w[at[~left]].sum()) >= min_leaf:
                        gain = impurity(at) - impurity(at[left]) - impurity(at[~left])
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, f, b)
        if best[1] is None:
            out[every] = c / c.sum()
            return
        _, f, b = best
        for side, keep in ((0, lambda a: a[bins[a, f] <= b]), (1, lambda a: a[bins[a, f] > b])):
            go(keep(at), keep(every), level + 1, FO._below(path, side))
    go(np.flatnonzero(w), np.arange(len(y)), 0, path)
    return out


@pytest.mark.parametrize("classes", [2, 3])
@pytest.mark.parametrize("local", [1 << 19, 100])
def test_equals_trees_grown_row_by_row(spark, monkeypatch, classes, local):
    monkeypatch.setattr(FO, "LOCAL_ROWS", local)
    x, y = rows(classes=classes)
    df = frame(spark, x, y)
    model = forest().fit(df)
    assert any((t.state == 1).any() or len(t.state) > 1 for t in model.tops) == (local == 100)
    got, prediction = scores(model.transform(df))
    hashes = np.array([r[0] for r in df.orderBy("i").select(F.xxhash64("i")).collect()], np.int64).view(np.uint64)
    bins = FO.binned(x, model.edges)
    want = np.zeros((len(y), classes))
    for t in range(TREES):
        path = np.array([FO._tree_salt(2, t)], np.uint64)
        want += plain(bins, y, FO.weights(hashes, 1, t).astype(float), classes, model.tried, 3, 30, path) / TREES
    assert np.allclose(got, want, atol=1e-9)
    assert prediction == [float(a) for a in got.argmax(axis=1)]


def test_same_forest_whatever_the_partitioning(spark):
    x, y = rows()
    a = scores(forest().fit(frame(spark, x, y)).transform(frame(spark, x, y)))
    order = np.random.default_rng(1).permutation(len(x))
    df = frame(spark, x, y)
    got = df.collect()
    other = spark.createDataFrame([got[i] for i in order], df.schema).repartition(7)
    b = scores(forest().fit(other).transform(df.repartition(5)))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_trees_over_many_blocks_and_passes_equal_one_pass(spark, monkeypatch):
    x, y = rows(400)
    df = frame(spark, x, y).repartition(9)
    one = scores(forest().fit(df).transform(df))
    for name, value in (("LOCAL_ROWS", 120), ("HIST_BYTES", 40000), ("FAN_IN", 2), ("SHARES", 64)):
        monkeypatch.setattr(FO, name, value)
    many = scores(forest().fit(df).transform(df))
    assert np.allclose(one[0], many[0], atol=1e-12) and one[1] == many[1]


def test_weights_are_poisson():
    w = FO.weights(np.arange(200000, dtype=np.uint64), 1, 3)
    assert abs(w.mean() - 1) < .02 and abs(w.var() - 1) < .03 and abs((w == 0).mean() - np.exp(-1)) < .01
    assert abs(np.corrcoef(w, FO.weights(np.arange(200000, dtype=np.uint64), 1, 4))[0, 1]) < .02


def test_tiny_and_odd_tables(spark):
    x, y = rows(3)
    one = frame(spark, x[:1], y[:1] * 0 + 1)
    p, prediction = scores(forest().fit(one).transform(one))
    assert p.tolist() == [[0.0, 1.0]] and prediction == [1.0]
    zero = frame(spark, x, y * 0)
    assert scores(forest().fit(zero).transform(zero)) [1] == [0.0] * 3
    assert forest().fit(one).transform(one.where("i > 5")).count() == 0
    twice = one.union(one)                       # rows are scored as rows, not as keys
    assert forest().fit(one).transform(twice).count() == 2
    with pytest.raises(ValueError):
        forest().fit(one.where("i > 5"))
