"""Cubic rotation, mergeable distinct counts, joins over stored layouts, multi-predictor imputation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tessera.operators import agg as A
from tessera.operators import image as IM
from tessera.operators import relate as R
from tessera.plans import passengers as PS
from tessera.plans.registry import all_queries
from tessera.sources import fixtures as fx


# ---- AR6

def spline_matrix(n):
    """Values from coefficients, with mirrored ends: the system that the prefilter solves."""
    m = np.zeros((n, n))
    for i in range(n):
        for o, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
            j = abs(i + o)
            m[i, 2 * n - 2 - j if j >= n else j] += w
    return m


@pytest.mark.parametrize("n", [2, 3, 8, 28])
def test_prefilter_solves_the_spline_system(n):
    x = np.random.default_rng(n).normal(size=(3, n))
    c = IM._prefiltered(x)
    assert np.allclose(c @ spline_matrix(n).T, x, atol=1e-10)


def plain_rotation(img, angle):
    """One image, one pixel at a time, coefficients by a dense solve."""
    h, w = img.shape
    c = np.linalg.solve(spline_matrix(h), np.linalg.solve(spline_matrix(w), img.T).T)
    t = np.deg2rad(angle)
    out = np.zeros((h, w))

    def basis(u):
        u = abs(u)
        return 2 / 3 - u * u + u ** 3 / 2 if u < 1 else (2 - u) ** 3 / 6 if u < 2 else 0.0
    for y in range(h):
        for x in range(w):
            dy, dx = y - (h - 1) / 2, x - (w - 1) / 2
            sy, sx = np.cos(t) * dy + np.sin(t) * dx + (h - 1) / 2, -np.sin(t) * dy + np.cos(t) * dx + (w - 1) / 2
            if not (-1e-9 <= sy <= h - 1 + 1e-9 and -1e-9 <= sx <= w - 1 + 1e-9):
                continue
            for j in range(int(np.floor(sy)) - 1, int(np.floor(sy)) + 3):
                for i in range(int(np.floor(sx)) - 1, int(np.floor(sx)) + 3):
                    a, b = abs(j), abs(i)
                    a, b = 2 * h - 2 - a if a >= h else a, 2 * w - 2 - b if b >= w else b
                    out[y, x] += basis(sy - j) * basis(sx - i) * c[a, b]
    return out


def test_cubic_rotation_against_a_plain_version():
    imgs = np.random.default_rng(1).random((4, 7, 9))
    angles = np.array([-7.0, 3, 30, 6])
    got = IM.rotate_images(imgs, angles)
    assert np.allclose(got, [plain_rotation(i, a) for i, a in zip(imgs, angles)], atol=1e-6)


def test_cubic_is_nearer_than_bilinear_on_a_smooth_image():
    yy, xx = np.mgrid[0:28, 0:28] - 13.5

    def smooth(y, x):
        return np.exp(-(y ** 2 + 2 * x ** 2) / 60) + .3 * np.sin(x / 3) * np.cos(y / 4)
    for angle in (-7, 2, 5):
        t = np.deg2rad(angle)
        want = smooth(np.cos(t) * yy + np.sin(t) * xx, -np.sin(t) * yy + np.cos(t) * xx)
        inner = (slice(4, -4), slice(4, -4))
        cubic, linear = (np.abs(IM.rotate_images(smooth(yy, xx)[None], np.array([angle]), o)[0] - want)[inner].max()
                         for o in (3, 1))
        assert cubic < linear / 5


# ---- AG3

def test_exact_distinct_counts_collapse_rows_before_they_expand(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "b", None), (1, None, None), (2, None, 3), (None, "a", 1)],
                               "k int, x string, y int")
    got = sorted(map(tuple, A.group_nunique(df, ["k"], {"nx": "x", "ny": "y", "nk": "k"}).collect()))
    assert got == [(1, 2, 1, 1), (2, 0, 1, 1)]
    plan = A.group_nunique(df, ["k"], {"nx": "x", "ny": "y"})._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan[plan.index("Expand"):]     # the collapse stands below


def test_sketches_merge_to_what_one_pass_gives(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 10).alias("day"),
                                     F.xxhash64(F.col("id") % 50_000).alias("x"))
    once = A.distinct_sketches(df, ["k"], ["x"])
    daily = A.distinct_sketches(df, ["k", "day"], ["x"])
    merged = A.merge_sketches(daily, ["k"], ["x"])
    exact = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count_distinct("x").alias("n")).collect()}
    a, b = ({r["k"]: r["n"] for r in A.sketch_counts(s, {"n": "x"}).collect()} for s in (once, merged))
    bound = 4 * 1.04 / 2 ** (A.SKETCH_LG / 2)
    for k, n in exact.items():
        assert abs(a[k] - n) < bound * n and abs(b[k] - n) < bound * n
        assert abs(a[k] - b[k]) <= 0.02 * n
    assert daily.agg(F.max(F.octet_length("x"))).first()[0] < 2 ** A.SKETCH_LG + 200


# ---- JN2

def test_stored_layouts_join_without_an_exchange(spark):
    base = spark.range(1000).withColumnRenamed("id", "k")
    others = [spark.range(0, 1000, s).select(F.col("id").alias("k"), (F.col("id") * s).alias(f"v{s}")) for s in (2, 3, 7)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = R.join_left_stored(base, others, "k", 4)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        total = out.groupBy("k").count()
        assert "Exchange" not in total._jdf.queryExecution().executedPlan().toString()
        want = R.join_left_chain(base, others, "k")
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- PR16, FE10

def test_imputation_with_six_predictors_solves_the_normal_equations(spark):
    predictors = ["Pclass", "Sex", "SibSp", "Parch", "Fare", "Embarked"]
    feats = PS.passenger_features(fx.passengers(spark, SF_MID).withColumn("AgeRaw", F.col("Age")))
    rows = feats.select("row_id", "AgeRaw", *[F.col(c).cast("double") for c in predictors]).collect()
    x = np.array([[r[c] for c in predictors] + [1.0] for r in rows], float)
    age = np.array([np.nan if r["AgeRaw"] is None else r["AgeRaw"] for r in rows])
    known = ~np.isnan(age)
    w = np.linalg.lstsq(x[known], age[known], rcond=None)[0]
    want = {r["row_id"]: a if k else p for r, a, k, p in zip(rows, age, known, x @ w)}
    out = all_queries()["impute_regression_multi"](spark, SF_MID).collect()
    assert len(out) == len(rows) and not known.all()
    for r in out:
        got = r["AgePred"] if r["Age"] is None else r["Age"]
        assert got is None or abs(got - want[r["row_id"]]) < 1e-6


def test_assembled_vectors_hold_the_columns_in_order(spark):
    from tessera.plans import bidders as BD
    feats = {r["bidder_id"]: r for r in all_queries()["bidder_features"](spark, SF_SMALL).collect()}
    for r in all_queries()["assemble_features"](spark, SF_SMALL).collect():
        assert [float(feats[r["bidder_id"]][c]) for c in BD.PREDICTORS] == r["features"].toArray().tolist()
