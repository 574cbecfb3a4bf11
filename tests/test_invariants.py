"""Invariants for the rows-only queries."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from tessera.operators import ids as ID
from tessera.operators import image as IM
from tessera.operators import model as M
from tessera.operators import window as WN
from tessera.sources import fixtures as fx


def test_pca_orthonormal_and_descending(spark):
    _, model = M.pca_project(fx.digits(spark, SF_SMALL), "px", 6)
    pc = model.pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(6), atol=1e-8)
    ev = model.explainedVariance.toArray()
    assert all(ev[i] >= ev[i + 1] for i in range(len(ev) - 1))


def test_stratified_split_exact_counts(spark):
    inc = fx.incidents(spark, SF_MID).select("row_id", "Category")
    s = WN.stratified_split(inc, "Category", "row_id", 0.5, 0.1, seed=7)
    got = {(r.Category, r.part): r.n for r in s.groupBy("Category", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {r.Category: r.n for r in inc.groupBy("Category").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c, n in totals.items():
        # per-class counts are rounded half up (Spark ``round``)
        assert got[(c, "train")] == int(n * 0.5 + 0.5)
        assert got.get((c, "test"), 0) == int(n * 0.1 + 0.5)


def test_same_seed_same_result_any_partitioning(spark):
    inc = fx.incidents(spark, SF_SMALL).select("row_id", "Category")
    ref = None
    for n in (1, 4, 16):
        s = WN.stratified_split(inc.repartition(n), "Category", "row_id", 0.5, 0.1, seed=3, out="part")
        rows = sorted((r.row_id, r.part) for r in s.collect())
        ref = ref or rows
        assert rows == ref
    rot = None
    for n in (1, 4, 16):
        r = IM.augment_rotate(fx.digits(spark, SF_SMALL).repartition(n), seed=5)
        rows = sorted((x.row_id, tuple(np.round(x.px, 6))) for x in r.collect())
        rot = rot or rows
        assert rows == rot


def test_rotation_by_zero_is_identity():
    imgs = np.random.default_rng(0).random((3, 8, 8))
    assert np.allclose(IM.rotate_images(imgs, np.zeros(3)), imgs.astype(np.float32), atol=1e-6)
    r = IM.rotate_images(imgs, np.full(3, 90.0))
    assert np.allclose(r[:, 1:-1, 1:-1], np.rot90(imgs, 1, axes=(1, 2)).astype(np.float32)[:, 1:-1, 1:-1], atol=1e-5)


def test_rotation_angles_in_range(spark):
    d = fx.digits(spark, SF_SMALL).select(IM.rotation_angle(1, "row_id").alias("a"))
    r = d.agg(F.min("a"), F.max("a")).first()
    assert r[0] >= -7 and r[1] <= 6


def test_gbt_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 3) + (i % 5) * 0.1, float(i % 7)) for i in range(120)],
                               "label double, x double, y double")
    tr = M.assemble(df, ["x", "y"])
    m = M.fit_gbt_multiclass(tr, 3, "label", "features", max_iter=3, max_depth=2)
    out = m.transform(tr, "features", "proba").collect()
    for r in out:
        assert all(0 <= p <= 1 for p in r.proba) and abs(sum(r.proba) - 1) < 1e-9
    assert sum(r.prediction == r.label for r in out) / len(out) > 0.9


def test_models_beat_majority_on_separable_data(spark):
    df = spark.createDataFrame([(float(i % 2), (i % 2) * 2.0 + (i % 7) * 0.01, (i % 3) * 1.0) for i in range(200)],
                               "label double, a double, b double")
    tr = M.assemble(df, ["a", "b"])
    rf = M.random_forest("label", "features", 10, 2, 5).fit(tr).transform(tr)
    lr = M.logistic(200, "label", "features", 50).fit(tr).transform(tr)
    for out in (rf, lr):
        acc = out.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        assert acc > 0.9


def test_fold_union_is_whole_table(spark):
    b = fx.bidders(spark, SF_MID).select("bidder_id", "outcome")
    for f in (ID.kfold_contiguous(b, ["bidder_id"], 3), ID.kfold_stratified(b, "outcome", ["bidder_id"], 3)):
        rows = f.collect()
        assert len(rows) == b.count() and len({r.bidder_id for r in rows}) == len(rows)
        assert {r.fold for r in rows} == {0, 1, 2}


def test_oof_scores_each_row_once(spark):
    b = fx.bidders(spark, SF_SMALL).where("split = 'train'").withColumn("label", F.col("outcome"))
    b = M.assemble(b.withColumn("x", F.col("bidder_id") % 7), ["x"])
    f = ID.kfold_contiguous(b, ["bidder_id"], 3)
    s = M.oof_scores(f, "bidder_id", "fold", 3, [("rf", lambda d: M.random_forest("label", "features", 3, 2, 3).fit(d))])
    rows = s.collect()
    assert len(rows) == b.count() and len({r.bidder_id for r in rows}) == len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mlp_predicts_known_classes(spark):
    d = fx.digits(spark, SF_SMALL).withColumn("features", array_to_vector("px")).withColumn("label", F.col("label").cast("double"))
    out = M.mlp(64, [8], 10, "label", "features", 5).fit(d).transform(d)
    assert {r.prediction for r in out.select("prediction").distinct().collect()} <= set(float(i) for i in range(10))


def test_pipeline_selectors_agree_with_f_ranking(spark):
    from tessera.operators import encode as E
    li = spark.read.parquet(SF_SMALL + "/lineitem.parquet")
    feats = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    d = li.withColumn("label", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
    best = [r.feature for r in E.select_k_best(d, feats, "label", 2).collect()]
    vec = M.assemble(d.withColumn("const", F.lit(1.0)), feats + ["const"])
    model = E.kbest_selector(2).fit(vec)
    assert sorted(feats[i] for i in model.selectedFeatures) == sorted(best)
    kept = E.variance_selector().fit(vec).selectedFeatures
    assert sorted(kept) == [0, 1, 2, 3]  # the constant slot is dropped


def test_crossvalidator_matches_fold_loop(spark):
    b = fx.bidders(spark, SF_SMALL).withColumn("label", F.col("outcome")).withColumn("x", (F.col("bidder_id") % 11).cast("double"))
    tr = ID.kfold_stratified(M.assemble(b, ["x"]), "label", ["bidder_id"], 3, "fold").persist()
    est = M.logistic(tr.count(), "label", "features", 20)
    loop = {r.fold: r.accuracy for r in M.cv_accuracy(tr, "fold", 3, lambda d: est.fit(d), "label").collect()}
    assert abs(M.cv_mean_accuracy(tr, "fold", est, "label") - loop[-1]) < 1e-9


def test_polynomial_voters_take_the_full_width(spark, monkeypatch):
    """The digits have 64 pixels, fewer than the reference's 200 components."""
    from tessera.plans.catalog import models

    class Stop(Exception):
        pass

    class Net:
        def fit(self, df):
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    def pca(df, col, k, out="pca"):
        assert k == 64
        raise Stop
    monkeypatch.setattr(M, "pca_project", pca)
    monkeypatch.setattr(M, "mlp", lambda *a: Net())
    for q in (models.fit_poly_svm, models.flow_digits):
        with pytest.raises(Stop):
            q(spark, SF_SMALL)
