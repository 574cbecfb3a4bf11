"""Operator 9, toxicity: a classifier chain over label categories.

The chain predicts the categories one after another; the linear model of a
category sees the document's features and the probabilities of all earlier
categories. While it is trained those probabilities come from models that have
not seen the row (out-of-fold); when documents are scored they come from the
earlier models themselves.

Features are the presence of words and of word beginnings (4 to 8 bytes, A-Z
lower-cased), known by a 64-bit hash. The ``n_features`` with the largest
chi-square against any category in the labelled sample are used. Fitting takes
a bounded sample of the labelled rows: about ``sample_rows`` of them, by a hash
of doc_id. Both bounds are parameters. Every document is scored on its whole
text; scoring needs no shuffle, only the small model.

Defined results: null and empty text have no feature (the model's intercepts
decide); labelled rows with a null id, a null label or no document are not
used for fitting; repeated labels of an id count once (the largest); without
both classes in the sample a category's probability is its share there (0
with no row). Repeated rows are scored each alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import small_batches, staged, text_of
from .words import byte_sums, pieces, span_hashes, word_spans

PREFIXES = (4, 5, 6, 7, 8)
SAMPLE_ROWS = 12_000
N_FEATURES = 3_000
FOLDS = 4
THRESHOLD = 0.5


def _hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, feature hash) for whole words and for each beginning."""
    sums = byte_sums(data, lower=True)
    yield np.arange(len(s)), span_hashes(sums, s, e)
    for k in PREFIXES:
        longer = np.flatnonzero(e - s > k)
        yield longer, span_hashes(sums, s[longer], s[longer] + k, seed=k)


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b.column(b.schema.get_field_index("t"))
        found: list[np.ndarray] = []
        for at, to, data, offs in pieces(text):
            s, e, first = word_spans(data, offs)
            doc = np.repeat(np.arange(to - at), np.diff(first))
            d, h = (np.concatenate(x) for x in zip(*((doc[w], h) for w, h in _hashes(data, s, e))))
            order = np.lexsort((h, d))
            d, h = d[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            d, h = d[new], h[new]
            cut = np.searchsorted(d, np.arange(to - at + 1))
            found += [h[i:j].view(np.int64) for i, j in zip(cut, cut[1:])]
        keep = [i for i, f in enumerate(b.schema.names) if f != "t"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(found, pa.list_(pa.int64()))],
                                         [*(b.schema.names[i] for i in keep), "features"])


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id",
                    text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, fold, y_0.., features) of about ``sample_rows`` labelled documents, written."""
    small_batches(docs.sparkSession)
    y = [f"y_{i}" for i in range(len(categories))]
    lab = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                        *[F.col(c).cast("double").alias(n) for c, n in zip(categories, y)])
    lab = lab.dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in y])
    lab = staged(lab, "labels")
    share = min(1.0, sample_rows / max(1, lab.count()))
    spread = 1 << 30
    lab = lab.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(spread)) < int(share * spread))
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    j = t.join(lab, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    schema = "doc_id long, fold int, " + ", ".join(f"{n} double" for n in y) + ", features array<long>"
    return staged(j.select("doc_id", "fold", *y, "t").mapInArrow(_feature_lists, schema), "labelled")


def choose_features(sample: DataFrame, n_categories: int, n_features: int = N_FEATURES) -> list[int]:
    """The feature hashes with the largest chi-square against any category (bounded: ``n_features``)."""
    y = [f"y_{i}" for i in range(n_categories)]
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in y]).first()
    n = totals["n"]
    per = (sample.select(*y, F.explode("features").alias("f")).groupBy("f")
           .agg(F.count(F.lit(1)).cast("double").alias("df"), *[F.sum(c).alias(c) for c in y])
           .where(F.col("df") >= 4))
    scores = [F.lit(0.0)]
    for c in y:
        pos = totals[c] or 0.0
        if 0 < pos < n:
            expect = F.col("df") * F.lit(pos / n)
            rest = F.col("df") * F.lit(1 - pos / n)
            scores.append(((F.col(c) - expect) ** 2) / expect + ((F.col("df") - F.col(c) - rest) ** 2) / rest)
    score = F.greatest(*scores) if len(scores) > 1 else scores[0]
    top = per.select("f", score.alias("chi")).where(F.col("chi") > 3.84).orderBy(F.desc("chi"), "f").limit(n_features)
    return [r["f"] for r in top.collect()]


def fit_logistic(rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, y: np.ndarray, n_cols: int,
                 steps: int = 400, ridge: float = 0.5) -> np.ndarray:
    """Weights (features, extra columns, intercept) of a ridge logistic regression.

    ``rows`` and ``cols`` are the places of the ones of the feature matrix;
    accelerated gradient steps, scaled per weight by its curvature bound.
    """
    n, m = len(y), n_cols + extra.shape[1]
    share = y.mean() if n else 0.0
    w = np.zeros(m + 1)
    if not 0 < share < 1:
        w[-1] = -40.0 if share == 0 else 40.0
        return w
    per_row = np.bincount(rows, minlength=n) + np.abs(extra).sum(axis=1) + 1
    scale = np.concatenate([np.bincount(cols, weights=per_row[rows], minlength=n_cols),
                            (np.abs(extra) * per_row[:, None]).sum(axis=0), [per_row.sum()]]) / 4 + ridge
    w[-1] = math.log(share / (1 - share))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        z = np.bincount(rows, weights=v[cols], minlength=n) + extra @ v[n_cols:m] + v[-1]
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        grad = np.concatenate([np.bincount(cols, weights=g[rows], minlength=n_cols), extra.T @ g, [g.sum()]])
        grad[:-1] += ridge * v[:-1]
        new = v - grad / scale
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def predict(rows: np.ndarray, cols: np.ndarray, n: int, n_cols: int, chain: list[np.ndarray]) -> np.ndarray:
    """Probabilities (n, categories): each model sees those before it."""
    p = np.zeros((n, 0))
    for w in chain:
        z = np.bincount(rows, weights=w[cols], minlength=n) + p @ w[n_cols:n_cols + p.shape[1]] + w[-1]
        p = np.column_stack([p, 1 / (1 + np.exp(-np.clip(z, -40, 40)))])
    return p


def _incidence(features, chosen: np.ndarray):
    """(row, column) of the chosen features in lists of feature hashes."""
    n = np.fromiter(map(len, features), np.int64, len(features))
    rows = np.repeat(np.arange(len(n)), n)
    h = np.concatenate([*features, np.zeros(0, np.int64)]).astype(np.int64)
    if not len(chosen):
        return rows[:0], rows[:0]
    at = np.minimum(np.searchsorted(chosen, h), len(chosen) - 1)
    hit = chosen[at] == h
    return rows[hit], at[hit]


def _only_chosen(features: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, cols = _incidence(pdf["features"].tolist(), features)
            cut = np.searchsorted(rows, np.arange(len(pdf) + 1))
            yield pdf.assign(features=[features[cols[i:j]] for i, j in zip(cut, cut[1:])])
    return run


def _fit(features: np.ndarray, y: str, extra_cols: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        rows, cols = _incidence(pdf["features"].tolist(), features)
        extra = pdf[extra_cols].to_numpy(float).reshape(len(pdf), len(extra_cols))
        w = fit_logistic(rows, cols, extra, pdf[y].to_numpy(float), len(features))
        return pd.DataFrame({"model": [int(pdf["model"].iloc[0])], "w": [w.tolist()]})
    return run


def _out_of_fold(features: np.ndarray, folds: list[np.ndarray], extra_cols: list[str], name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, cols = _incidence(pdf["features"].tolist(), features)
            extra = pdf[extra_cols].to_numpy(float).reshape(len(pdf), len(extra_cols))
            p = np.zeros(len(pdf))
            for f, w in enumerate(folds):
                z = np.bincount(rows, weights=w[cols], minlength=len(pdf)) + extra @ w[len(features):-1] + w[-1]
                own = (pdf["fold"] == f).to_numpy()
                p[own] = 1 / (1 + np.exp(-np.clip(z[own], -40, 40)))
            yield pdf.assign(**{name: p})
    return run


def fit_chain(sample: DataFrame, chosen: list[int], n_categories: int) -> list[np.ndarray]:
    """One model per category. The fits of a category (one per fold, one on all) run side by side."""
    features = np.sort(np.array(chosen, np.int64))
    none = np.zeros(len(features) + 1)
    none[-1] = -40.0
    extra_cols: list[str] = []
    chain: list[np.ndarray] = []
    data = staged(sample.mapInPandas(_only_chosen(features), sample.schema), "chosen")
    for c in range(n_categories):
        # model m < FOLDS leaves fold m out; model FOLDS has all rows: a bounded sample in each task
        models = data.select("*", F.explode(F.array(*[F.lit(i) for i in range(FOLDS + 1)])).alias("model"))
        models = models.where(F.col("model") != F.col("fold")).groupBy("model")
        got = {r["model"]: np.array(r["w"]) for r in
               models.applyInPandas(_fit(features, f"y_{c}", list(extra_cols)), "model int, w array<double>").collect()}
        empty = np.insert(none, len(features), np.zeros(len(extra_cols)))
        chain.append(got.get(FOLDS, empty))
        if c + 1 < n_categories:
            folds = [got.get(i, empty) for i in range(FOLDS)]
            schema = StructType([*data.schema.fields]).add(f"p_{c}", DoubleType())
            data = staged(data.mapInPandas(_out_of_fold(features, folds, list(extra_cols), f"p_{c}"), schema), "oof")
            extra_cols.append(f"p_{c}")
    return chain


def score(docs: DataFrame, chosen: list[int], chain: list[np.ndarray], categories: Sequence[str],
          id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id and ``p_<category>`` of every document; with ``carry`` its whole row too, as the struct ``row``."""
    small_batches(docs.sparkSession)
    table = np.sort(np.array(chosen, np.int64)).view(np.uint64)
    order = np.argsort(table)                 # hashes are compared unsigned while scoring
    unsigned, column_of = table[order], order
    maybe = np.zeros(1 << 20, bool)           # low bits of the chosen hashes: most words end here
    low = np.uint64((1 << 20) - 1)
    maybe[(unsigned & low).astype(np.int64)] = True
    n_cols = len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            text = b.column(b.num_columns - 1)
            if carry:                          # the text is in the row that is carried anyway
                text = pa.compute.cast(text.field(text_col), pa.large_string())
            for at, to, data, offs in pieces(text):
                s, e, first = word_spans(data, offs)
                doc = np.repeat(np.arange(to - at), np.diff(first))
                rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for w, h in _hashes(data, s, e) if n_cols else ():
                    may = np.flatnonzero(maybe[(h & low).astype(np.int64)])
                    h = h[may]
                    place = np.minimum(np.searchsorted(unsigned, h), n_cols - 1)
                    hit = unsigned[place] == h
                    rows.append(doc[w[may[hit]]])
                    cols.append(column_of[place[hit]])
                key = np.unique(np.concatenate(rows) * max(1, n_cols) + np.concatenate(cols))
                out.append(predict(key // max(1, n_cols), key % max(1, n_cols), to - at, n_cols, chain))
            p = np.concatenate(out) if out else np.zeros((0, len(chain)))
            cols = [b.column(0), *(pa.array(p[:, i]) for i in range(len(chain)))]
            names = ["doc_id", *(f"p_{c}" for c in categories)]
            if carry:
                cols, names = [*cols, b.column(1)], [*names, "row"]
            yield pa.RecordBatch.from_arrays(cols, names)

    source = F.struct("*").alias("row") if carry else text_of(text_col).alias("t")
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), source)
    fields = [StructField("doc_id", LongType()), *(StructField(f"p_{c}", DoubleType()) for c in categories)]
    return t.mapInArrow(run, StructType([*fields, *([t.schema["row"]] if carry else [])]))


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None,
             categories: Sequence[str] = ("quality", "toxic"), id_col: str = "doc_id", text_col: str = "text",
             sample_rows: int = SAMPLE_ROWS, n_features: int = N_FEATURES, carry: bool = False) -> DataFrame:
    """doc_id, ``p_<category>`` for each category of the chain, in order (and ``row``, see ``score``).

    ``train_docs`` (by default ``docs``) holds the texts of the labelled rows.
    """
    sample = labelled_sample(docs if train_docs is None else train_docs, labels, categories, id_col, text_col,
                             sample_rows)
    chosen = choose_features(sample, len(categories), n_features)
    chain = fit_chain(sample, chosen, len(categories))
    return score(docs, chosen, chain, categories, id_col, text_col, carry)
