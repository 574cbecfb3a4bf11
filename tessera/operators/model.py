"""Models and cross-validation on MLlib (ML1-ML11, FE4, FE10).

Every fit is a distributed MLlib fit. The only driver loops are over a fixed,
small number of folds, models or classes; no loop runs over rows or keys.
Independent fits (classes of a one-vs-rest model, folds, models) are
submitted from a small thread pool, so their jobs share the cluster
instead of queueing one after another. The shared input is persisted once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import standardized_vectors
from .forest import RandomForest
from .matrix import row_blocks
from .subspace import fit_subspace

# concurrent independent fits (jobs submitted from driver threads)
PARALLEL_FITS = 4


def side_by_side(fn, items, workers: int = PARALLEL_FITS) -> list:
    """``fn`` of each item, in the order of the items; their Spark jobs run at the same time."""
    if workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as ex:
        return list(ex.map(fn, items))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """FE10: named numeric columns -> one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(
        df.withColumns({c: F.col(c).cast("double") for c in cols}))


def random_forest(label: str = "label", features: str = "features", num_trees: int = 150,
                  min_leaf: int = 3, max_depth: int = 30, seed: int = 1, key: Sequence[str] = ()) -> RandomForest:
    """ML1: forest; the reference grows trees without a depth limit (30 is the default here)
    and bounds the leaf size (A11). ``key``: unique key of the rows, by which bootstraps are drawn."""
    return RandomForest(label, features, num_trees, min_leaf, max_depth, seed, tuple(key))


def logistic(n_rows: int, label: str = "label", features: str = "features", max_iter: int = 100) -> LogisticRegression:
    """ML2: L2-penalised logistic regression equivalent to C = 1 on unscaled features
    (regParam = 1 / n, A12)."""
    return LogisticRegression(labelCol=label, featuresCol=features, regParam=1.0 / max(n_rows, 1),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter)


def linear(label: str = "label", features: str = "features") -> LinearRegression:
    """ML4."""
    return LinearRegression(labelCol=label, featuresCol=features, regParam=0.0, solver="normal")


def mlp(n_in: int, hidden: Sequence[int], n_out: int, label: str = "label", features: str = "features",
        max_iter: int = 100, seed: int = 1) -> MultilayerPerceptronClassifier:
    """ML5/ML7: perceptron trained with L-BFGS."""
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features,
                                          layers=[n_in, *hidden, n_out], solver="l-bfgs",
                                          maxIter=max_iter, seed=seed)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores: a small table in one file would be fitted by one task."""
    df = df.checkpoint()        # asking for the partitions would run the plan another time
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


@dataclass
class GBTMulticlass:
    """ML3: one binary boosted-tree model per class; probabilities sigmoid(2 * margin)
    normalised over the classes (A13)."""
    models: list
    n_classes: int

    def transform(self, df: DataFrame, features: str = "features", out: str = "probability") -> DataFrame:
        d = df
        for k, m in enumerate(self.models):
            d = m.setFeaturesCol(features).setRawPredictionCol(f"_raw{k}").setProbabilityCol(f"_p{k}") \
                 .setPredictionCol(f"_y{k}").transform(d)
            d = (d.withColumn(f"_s{k}", 1.0 / (1.0 + F.exp(-2.0 * vector_to_array(f"_raw{k}")[1])))
                  .drop(f"_raw{k}", f"_p{k}", f"_y{k}"))
        total = sum(F.col(f"_s{k}") for k in range(self.n_classes))
        d = d.withColumn(out, F.array(*[F.col(f"_s{k}") / total for k in range(self.n_classes)]))
        d = d.withColumn("prediction", F.array_position(F.col(out), F.array_max(F.col(out))) - 1)
        return d.drop(*[f"_s{k}" for k in range(self.n_classes)])


def fit_gbt_multiclass(df: DataFrame, n_classes: int, label: str = "label", features: str = "features",
                       max_iter: int = 50, max_depth: int = 5, step: float = 0.1, seed: int = 1) -> GBTMulticlass:
    """ML3 fit: ``n_classes`` binary fits on (label == k); labels are 0..n-1, fitted concurrently."""
    base = df.select(label, features).persist()

    def fit(k):
        d = base.withColumn("_yk", (F.col(label) == k).cast("double"))
        g = GBTClassifier(labelCol="_yk", featuresCol=features, maxIter=max_iter, maxDepth=max_depth,
                          stepSize=step, seed=seed)
        return g.fit(d)

    models = side_by_side(fit, list(range(n_classes)))
    base.unpersist()
    return GBTMulticlass(models, n_classes)


def poly_svm(degree: int, label: str = "label", features: str = "features", max_iter: int = 100):
    """ML6: polynomial feature expansion + one-vs-rest linear SVM (the kernel SVM re-aimed)."""
    return (PolynomialExpansion(degree=degree, inputCol=features, outputCol="_poly"),
            OneVsRest(classifier=LinearSVC(maxIter=max_iter, regParam=0.0), labelCol=label, featuresCol="_poly",
                      parallelism=PARALLEL_FITS))


def fit_poly_svm(df: DataFrame, degree: int, label: str = "label", features: str = "features",
                 max_iter: int = 100):
    expand, ovr = poly_svm(degree, label, features, max_iter)
    base = expand.transform(df.select(label, features)).persist()  # read by every class and iteration
    model = ovr.fit(base)
    base.unpersist()
    return lambda d: model.transform(expand.transform(d)).drop("_poly", "rawPrediction")


def positive_proba(df: DataFrame, col: str = "probability", out: str = "score") -> DataFrame:
    """ML9: probability of class 1 as a double column."""
    return df.withColumn(out, vector_to_array(col)[1])


def proba_array(df: DataFrame, col: str = "probability", out: str = "proba") -> DataFrame:
    """ML9: whole probability vector as array<double>."""
    return df.withColumn(out, vector_to_array(col))


@dataclass
class PCAFit:
    """Components as columns, and each one's share of the whole variance."""
    pc: DenseMatrix
    explainedVariance: DenseVector


def pca_project(df: DataFrame, col: str, k: int, out: str = "pca"):
    """FE4: standardise each element (sample std, zero -> 1, train+test together A14),
    then PCA to k components. Returns (frame with ``out`` array, PCA model)."""
    vec = standardized_vectors(df, col, "_v", drop_constant=False).withColumn("_a", vector_to_array("_v")).checkpoint()
    blocks = row_blocks(vec, "_a", "_a")
    fit = fit_subspace(blocks, k)
    blocks.unpersist()
    share = fit.variance / (fit.total_variance or 1.0)
    model = PCAFit(DenseMatrix(*fit.components.shape, fit.components.ravel(order="F")), DenseVector(share))
    return fit.transform(vec, "_a", out).drop("_v", "_a"), model


def fold_fits(df: DataFrame, fold: str, k: int, make: Callable[[DataFrame], Model],
              score: Callable[[Model, DataFrame], DataFrame]) -> DataFrame:
    """Fit on all folds but one, score the held-out fold, for each of k folds
    (fits run concurrently); the held-out results are unioned (each row scored once)."""
    models = side_by_side(lambda f: make(df.where(F.col(fold) != f)), list(range(k)))
    out = None
    for f, model in enumerate(models):
        s = score(model, df.where(F.col(fold) == f)).withColumn(fold, F.lit(f))
        out = s if out is None else out.unionByName(s)
    return out


def cv_accuracy(df: DataFrame, fold: str, k: int, make, label: str = "label") -> DataFrame:
    """ML10: accuracy per held-out fold, plus the mean as fold -1."""
    from .metric import accuracy_by
    df = df.checkpoint()
    preds = fold_fits(df, fold, k, make, lambda m, d: m.transform(d).select(fold, label, "prediction"))
    per = accuracy_by(preds, [fold], "prediction", label)
    mean = per.agg(F.avg("accuracy").alias("accuracy")).select(F.lit(-1).alias(fold), "accuracy")
    return per.unionByName(mean)


def oof_scores(df: DataFrame, row_id: str, fold: str, k: int,
               models: Sequence[tuple[str, Callable[[DataFrame], Model]]]) -> DataFrame:
    """ML11: out-of-fold positive-class scores of several models: long table
    (row_id, fold, model, score)."""
    df = df.checkpoint()
    out = None
    for name, make in models:
        s = fold_fits(df, fold, k, make,
                      lambda m, d: positive_proba(m.transform(d)).select(row_id, "score"))
        s = s.withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


def cv_mean_accuracy(df: DataFrame, fold: str, estimator, label: str = "label") -> float:
    """ML10, MLlib form: ``CrossValidator`` over the given fold column (user-assigned
    folds, e.g. from ``kfold_stratified``); returns the mean held-out accuracy."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=ParamGridBuilder().build(), evaluator=ev,
                        foldCol=fold, parallelism=PARALLEL_FITS)
    return float(cv.fit(df.withColumn(fold, F.col(fold).cast("int"))).avgMetrics[0])
