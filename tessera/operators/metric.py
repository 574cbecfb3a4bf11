"""Votes and metrics (ML12-ML16), as aggregates over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import vote_and, vote_or  # noqa: F401  (re-exported)


def accuracy(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """ML15: one row, mean of (pred == label)."""
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def accuracy_by(df: DataFrame, keys: Sequence[str], pred: str = "prediction", label: str = "label") -> DataFrame:
    """ML15 per group (e.g. per fold)."""
    return df.groupBy(*keys).agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def clipped_true_proba(proba: str | Column, label: str | Column, eps: float = 1e-15) -> Column:
    """Probability given to the true class, rows renormalised and clipped to [eps, 1 - eps]."""
    p = F.col(proba) if isinstance(proba, str) else proba
    y = F.col(label) if isinstance(label, str) else label
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    pt = F.get(p, y.cast("int")) / total
    return F.greatest(F.least(pt, F.lit(1.0 - eps)), F.lit(eps))


def log_loss(df: DataFrame, proba: str = "proba", label: str = "label", eps: float = 1e-15) -> DataFrame:
    """ML16: multiclass log loss, one row."""
    return df.agg((-F.avg(F.ln(clipped_true_proba(proba, label, eps)))).alias("log_loss"))
