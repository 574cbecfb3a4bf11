"""ML10/ML11: logistic regressions of all folds and penalties in one scan per iteration.

Separate fits of k folds read the training rows k times per iteration. Here
one pass adds up gradient and curvature of every model at once: a row
contributes to each model that it trains, all but that of its own fold.
Newton steps (with halving if the loss rises) make a handful of passes do for
convergence to rounding. The curvature is models x (d + 1) ** 2 numbers, for
tens to some hundreds of features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matrix import Block, Blocks, over_blocks, row_blocks

MAX_ITER = 60
TOLERANCE = 1e-12


@dataclass
class FoldLogistic:
    """Models (held-out fold or None, penalty) with their weights (intercept last)."""
    models: list[tuple[int | None, float]]
    weights: np.ndarray
    passes: int

    def of(self, fold: int | None, l2: float | None = None) -> np.ndarray:
        return next(w for (f, p), w in zip(self.models, self.weights) if f == fold and l2 in (None, p))

    def score(self, df: DataFrame, features: str, fold: str, l2: float | None = None, out: str = "score") -> DataFrame:
        """Each row's positive-class probability by the model that did not see its fold. JVM-side."""
        folds = sorted(f for f, p in self.models if f is not None and l2 in (None, p))
        x = vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)

        def literal(v) -> Column:
            return F.array(*[F.lit(float(a)) for a in v])
        w = F.coalesce(*[F.when(F.col(fold) == f, literal(self.of(f, l2))) for f in folds])
        z = F.aggregate(F.zip_with(F.concat(x.cast("array<double>"), F.array(F.lit(1.0))), w, lambda a, b: a * b),
                        F.lit(0.0), lambda a, b: a + b)
        return df.withColumn(out, 1.0 / (1.0 + F.exp(-z)))


def _terms(models: list, weights: np.ndarray):
    def run(b: Block) -> np.ndarray:
        x = np.column_stack([b.x, np.ones(len(b.x))])
        out = []
        for (held, _), w in zip(models, weights):
            on = np.ones(len(x), bool) if held is None else b.fold != held
            xa, y = x[on], b.y[on]
            z = xa @ w
            p = 0.5 * (1 + np.tanh(z / 2))
            loss = np.logaddexp(0, z) - y * z
            out.append(np.concatenate([[loss.sum()], xa.T @ (p - y), ((xa * (p * (1 - p))[:, None]).T @ xa).ravel()]))
        return np.concatenate(out)
    return run


def fit_logistic_folds(blocks: Blocks, folds: Sequence[int | None], l2: Sequence[float] = (1.0,),
                       max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> FoldLogistic:
    """Minimise sum(log loss) + l2 / 2 * |w| ** 2 (intercept free) for every fold left out and every penalty.

    None among ``folds`` is the model of all rows. One job per iteration, for all models.
    """
    models = [(f, float(p)) for p in l2 for f in folds]
    d = blocks.width + 1
    m = len(models)
    penalty = np.array([p for _, p in models])[:, None] * np.append(np.ones(d - 1), 0.0)
    w, at, step = np.zeros((m, d)), np.zeros((m, d)), np.zeros((m, d))
    best, size = np.full(m, np.inf), np.ones(m)
    moving = np.ones(m, bool)
    passes = 0
    while moving.any() and passes < max_iter:
        got = over_blocks(blocks, _terms(models, w))
        passes += 1
        if got is None:
            break
        got = got.reshape(m, 1 + d + d * d)
        loss = got[:, 0] + 0.5 * (penalty * w * w).sum(axis=1)
        for i in np.flatnonzero(moving):
            if loss[i] > best[i] * (1 + 1e-14):                # too far: half the step from where it began
                size[i] /= 2
                w[i] = at[i] - size[i] * step[i]
                if size[i] < 1e-8:
                    w[i], moving[i] = at[i], False
                continue
            gradient = got[i, 1:1 + d] + penalty[i] * w[i]
            curvature = got[i, 1 + d:].reshape(d, d) + np.diag(penalty[i])
            best[i], at[i], size[i] = loss[i], w[i], 1.0
            step[i] = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
            if gradient @ step[i] < tolerance * max(1.0, loss[i]):
                moving[i] = False
            w[i] = at[i] - step[i]
    blocks.unpersist()
    return FoldLogistic(models, w, passes)


def oof_logistic(df: DataFrame, row_id: str, fold: str, k: int, label: str = "label", features: str = "features",
                 l2: float = 1.0, out: str = "score") -> DataFrame:
    """ML11: ``df`` with each row's out-of-fold probability; the k fits share every scan."""
    model = fit_logistic_folds(row_blocks(df, row_id, features, label, fold), list(range(k)), [l2])
    return model.score(df, features, fold, l2, out)
