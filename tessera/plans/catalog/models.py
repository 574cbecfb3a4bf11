"""Registered queries: models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from pyspark.ml.functions import array_to_vector

from ...functions import scalar as S
from ...functions.arrays import array_scale
from ...operators import boost as B
from ...operators import encode as E
from ...operators import folds as FO
from ...operators import ids as ID
from ...operators import kernel as K
from ...operators import metric as MT
from ...operators import model as M
from ...operators import nets as NN
from .. import bidders as BD
from .. import digits as DG
from .. import incidents as INC
from .. import passengers as PS

#: Components before the polynomial expansion, as many as the reference's; a shorter vector has all of its own.
PCA_K = 200
#: L-BFGS iterations of the perceptrons (the library's default).
MLP_ITER = 100


@query("vote_and", ["votes"], "SELECT row_id, CAST(coalesce(s1 > 0.5, false) AND coalesce(s2 > 0.5, false) AS INTEGER) AS vote FROM votes")
def vote_and(spark, d):
    """SC14/ML12: both scores above 0.5."""
    return fx.votes(spark, d).select("row_id", S.vote_and("s1", "s2").cast("int").alias("vote"))


@query("vote_or", ["votes"], "SELECT row_id, CAST(coalesce(s1 > 0.5, false) OR coalesce(s2 > 0.5, false) AS INTEGER) AS vote FROM votes")
def vote_or(spark, d):
    """SC14/ML13: either score above 0.5."""
    return fx.votes(spark, d).select("row_id", S.vote_or("s1", "s2").cast("int").alias("vote"))


@query("metric_accuracy", ["votes"], """
p AS (""" + """SELECT row_id, x AS vote FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, i ASC) AS rn FROM
  (SELECT *, count(*) OVER (PARTITION BY row_id, x) AS n FROM
    (SELECT row_id, unnest([p0, p1, p2, p3, p4]) AS x, generate_subscripts([p0, p1, p2, p3, p4], 1) AS i FROM votes) e) c) z
  WHERE rn = 1)
SELECT avg(CAST(p.vote = v.label % 4 AS DOUBLE)) AS accuracy FROM p JOIN votes v USING (row_id)""")
def metric_accuracy(spark, d):
    """ML15: accuracy of the plurality vote against label mod 4."""
    from ...functions.arrays import plurality_vote
    v = fx.votes(spark, d)
    p = v.select(plurality_vote(F.array(*[f"p{m}" for m in range(5)])).alias("prediction"),
                 (F.col("label") % 4).alias("label"))
    return MT.accuracy(p, "prediction", "label")


@query("metric_log_loss", ["votes"], """
SELECT -avg(ln(greatest(least(
    (CASE label % 3 WHEN 0 THEN s1 WHEN 1 THEN s2 ELSE 1.0 END) / (s1 + s2 + 1.0),
    1 - 1e-15), 1e-15))) AS log_loss FROM votes""")
def metric_log_loss(spark, d):
    """ML16: multiclass log loss of the (renormalised) vector (s1, s2, 1) against label mod 3."""
    v = fx.votes(spark, d).select(F.array("s1", "s2", F.lit(1.0)).alias("proba"), (F.col("label") % 3).alias("label"))
    return MT.log_loss(v, "proba", "label")


@query("fit_linear", None, """
SELECT regr_slope(l_extendedprice, l_quantity) AS coef, regr_intercept(l_extendedprice, l_quantity) AS intercept
FROM lineitem""")
def fit_linear(spark, d):
    """ML4: MLlib linear regression, one predictor (checked against regr_*)."""
    li = M.assemble(table(spark, d, "lineitem"), ["l_quantity"])
    m = M.linear("l_extendedprice", "features").fit(li)
    # the fitted model is one coefficient and an intercept
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "coef double, intercept double")


def _bidder_train(spark, d):
    feats = BD.bidder_features(fx.bids(spark, d), fx.bidders(spark, d), "train")
    return M.assemble(feats.withColumn("label", F.col("outcome")), BD.PREDICTORS)


@query("fit_random_forest")
def fit_random_forest(spark, d):
    """ML1 (+ML8): forest of 150 unbounded trees on the bidder features, hard predictions."""
    tr = _bidder_train(spark, d)
    m = M.random_forest("label", "features", min_leaf=2, key=["bidder_id"]).fit(tr)
    return m.transform(tr).select("bidder_id", F.col("prediction").cast("int").alias("prediction"))


@query("fit_logistic")
def fit_logistic(spark, d):
    """ML2: logistic regression (C = 1 equivalent) on the bidder features."""
    tr = _bidder_train(spark, d).checkpoint()
    m = M.logistic(tr.count(), "label", "features").fit(tr)
    return M.positive_proba(m.transform(tr)).select("bidder_id", "score")


@query("predict_proba")
def predict_proba(spark, d):
    """ML9: positive-class probability and the whole vector from a forest."""
    tr = _bidder_train(spark, d)
    m = M.random_forest("label", "features", min_leaf=2, key=["bidder_id"]).fit(tr)
    out = M.proba_array(M.positive_proba(m.transform(tr)))
    return out.select("bidder_id", "score", "proba")


@query("cv_scores")
def cv_scores(spark, d):
    """ML10: 3-fold stratified CV accuracy of a forest (folds 0..2 and mean as -1)."""
    tr = ID.kfold_stratified(_bidder_train(spark, d), "label", ["bidder_id"], 3, "fold")
    return M.cv_accuracy(tr, "fold", 3, lambda x: M.random_forest("label", "features", min_leaf=2, key=["bidder_id"]).fit(x), "label")


@query("oof_predictions")
def oof_predictions(spark, d):
    """ML11: out-of-fold scores of forest and logistic regression, contiguous folds."""
    tr = _bidder_train(spark, d)
    tr = ID.kfold_contiguous(tr, ["bidder_id"], 3, "fold").checkpoint()
    rf = M.oof_scores(tr, "bidder_id", "fold", 3, [
        ("rf", lambda x: M.random_forest("label", "features", min_leaf=2, key=["bidder_id"]).fit(x))])
    lr = FO.oof_logistic(tr, "bidder_id", "fold", 3).select(*[c for c in rf.columns if c != "model"], F.lit("lr").alias("model"))
    return rf.unionByName(lr)


@query("fit_gbt_multiclass")
def fit_gbt_multiclass(spark, d):
    """ML3: boosted trees of one multinomial deviance (50 rounds, depth 5) on the incident features, class probabilities."""
    feats, enc, _ = INC.train_features(fx.incidents(spark, d))
    cols = INC.all_feature_columns(enc)
    feats = feats.withColumn("label", (F.array_position(F.array(*[F.lit(c) for c in enc.classes]),
                                                        F.col("Category")) - 1).cast("double"))
    tr = M.assemble(feats, cols)
    m = B.fit_softmax_boosting(tr, len(enc.classes), "label", "features")
    return m.transform(tr, "features", "proba").select("row_id", "proba", "prediction")


def _digits_split(spark, d):
    dg = fx.digits(spark, d)
    return dg.withColumn("features", array_to_vector("px")).withColumn("label", F.col("label").cast("double"))


def _sizes(dg):
    """Input and output width of a net on the digits: their pixels and classes."""
    return E.common_length(dg, "px"), int(dg.agg(F.max("label")).first()[0]) + 1


@query("fit_mlp")
def fit_mlp(spark, d):
    """ML5: perceptron with hidden layers of 1000 and 500, L-BFGS, L2 term 1e-5, on the pixel vectors."""
    dg = _digits_split(spark, d)
    n_in, n_out = _sizes(dg)
    m = NN.fit_net(dg, [n_in, 1000, 500, n_out], max_iter=MLP_ITER)
    return m.transform(dg).select("row_id", F.col("prediction").cast("int").alias("prediction"))


@query("fit_poly_svm")
def fit_poly_svm(spark, d):
    """ML6: PCA -> tensor sketch of the degree-3 kernel -> one-vs-rest SVM."""
    dg = fx.digits(spark, d)
    pc, _ = M.pca_project(dg, "px", min(PCA_K, E.common_length(dg, "px")), "pca")
    pc = pc.withColumn("features", array_to_vector("pca")).withColumn("label", F.col("label").cast("double"))
    return K.fit_kernel_svm(pc, 3).transform(pc).select("row_id", F.col("prediction").cast("int").alias("prediction"))


@query("fit_augmented_mlp")
def fit_augmented_mlp(spark, d):
    """ML7: net of 1000 hidden units on scaled, shifted (x5) and rotated images, by mini-batches with momentum and
    a decaying rate; predicts the originals (scaled)."""
    from ...operators import image as IM
    # the images are few bytes, what is made of them is much work: a file's split would be one task
    dg = M.spread(fx.digits(spark, d).withColumn("label", F.col("label").cast("double")))
    n_in, n_out = _sizes(dg)
    aug = IM.augment_rotate(IM.scale_and_augment(dg, "px", "width"), "px", "width", ("row_id", "variant"), 1)
    m = NN.fit_sgd_net(aug.withColumn("features", array_to_vector("px")), [n_in, 1000, n_out], key=("row_id", "variant"))
    return m.transform(dg.withColumn("features", array_to_vector(array_scale("px", 255.0)))).select(
        "row_id", F.col("prediction").cast("int").alias("prediction"))


@query("flow_passengers")
def flow_passengers(spark, d):
    """ML17: passengers end to end -> submission (PassengerId, Survived)."""
    return PS.run_flow(fx.passengers(spark, d))


@query("flow_passengers_scores")
def flow_passengers_scores(spark, d):
    """ML10/ML11/ML17: accuracy per fold and of the out-of-fold AND vote."""
    return PS.flow_scores(fx.passengers(spark, d))


@query("flow_bidders")
def flow_bidders(spark, d):
    """ML17: bidders end to end -> submission (bidder_id, predictions)."""
    return BD.run_flow(fx.bids(spark, d), fx.bidders(spark, d))


@query("flow_bidders_scores")
def flow_bidders_scores(spark, d):
    """ML10/ML11/ML17: accuracy per fold of forest and logistic regression, and of the out-of-fold OR vote."""
    return BD.flow_scores(fx.bids(spark, d), fx.bidders(spark, d))


@query("flow_incidents")
def flow_incidents(spark, d):
    """ML18: incidents end to end -> Id + one probability column per category."""
    return INC.run_flow(fx.incidents(spark, d))


@query("flow_incidents_losses")
def flow_incidents_losses(spark, d):
    """ML16/ML18: log loss over all training rows and the parts of a stratified split."""
    return INC.flow_losses(fx.incidents(spark, d))


@query("flow_digits")
def flow_digits(spark, d):
    """ML19: digits end to end -> (ImageId, Label) by a five-voter plurality."""
    return DG.run_flow(fx.digits(spark, d), (F.col("row_id") % 5) == 0, pca_k=PCA_K, max_iter=MLP_ITER)


@query("impute_regression_multi")
def impute_regression_multi(spark, d):
    """PR16 with the reference's six predictors: MLlib linear regression fitted on
    passengers with a known Age, predicted for the others (rows-only)."""
    from ...operators import prep as P
    feats = PS.passenger_features(fx.passengers(spark, d).withColumn("AgeRaw", F.col("Age")))
    # the regression reads the age before the title-median fill
    feats = feats.withColumn("Age", F.col("AgeRaw")).drop("AgeRaw")
    out = P.impute_regression(feats, "Age", ["Pclass", "Sex", "SibSp", "Parch", "Fare", "Embarked"], "AgePred")
    return out.select("row_id", "Age", "AgePred")
