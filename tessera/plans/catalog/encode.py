"""Registered queries: encode."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...operators import encode as E
from ...operators import relate as R
from .. import bidders as BD

_TR = "tr AS (SELECT * FROM incidents WHERE split = 'train'), te AS (SELECT * FROM incidents WHERE split = 'test')"


@query("standardize_pop", ["incidents"], _TR + """,
s AS (SELECT avg(X) AS mx, stddev_pop(X) AS sx, avg(Y) AS my, stddev_pop(Y) AS sy FROM tr)
SELECT row_id, (X - mx) / CASE WHEN sx = 0 THEN 1 ELSE sx END AS X,
       (Y - my) / CASE WHEN sy = 0 THEN 1 ELSE sy END AS Y FROM te, s""")
def standardize_pop(spark, d):
    """FE1: population-std scaler fitted on train rows, applied to test rows."""
    i = fx.incidents(spark, d).select("row_id", "split", "X", "Y")
    tr, te = i.where(F.col("split") == "train"), i.where(F.col("split") == "test")
    return E.standardize_pop(tr, te, ["X", "Y"]).select("row_id", "X", "Y")


@query("standardize_samp", None, """
s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_linenumber, (l_quantity - mq) / CASE WHEN sq = 0 THEN 1 ELSE sq END AS l_quantity,
       (l_tax - mt) / CASE WHEN st = 0 THEN 1 ELSE st END AS l_tax FROM lineitem, s""")
def standardize_samp(spark, d):
    """FE2: sample std, zero std -> 1."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return E.standardize_samp(li, ["l_quantity", "l_tax"])


_PIXELS = """
e AS (SELECT row_id, CAST(unnest(list_append(px, width)) AS DOUBLE) AS v,
             unnest(generate_series(1, len(px) + 1)) AS i FROM digits),
s AS (SELECT i, avg(v) AS m, stddev_samp(v) AS s FROM e GROUP BY i HAVING stddev_samp(v) > 0),
k AS (SELECT i, m, s, row_number() OVER (ORDER BY i) - 1 AS pos FROM s)
"""


@query("drop_constant_columns", ["digits"], _PIXELS
       + "SELECT row_id, CAST(pos AS INTEGER) AS pos, (v - m) / s AS value FROM e JOIN k ON e.i = k.i")
def drop_constant_columns(spark, d):
    """FE3 (+FE2): every pixel, and one column that is constant, as a vector: the constant slot
    is dropped, the others standardised (sample std); one row per image and kept slot."""
    from pyspark.ml.functions import vector_to_array
    w = fx.digits(spark, d).select("row_id", F.array_append("px", F.col("width").cast("float")).alias("px"))
    v = E.standardized_vectors(w, "px")
    return v.select("row_id", F.posexplode(vector_to_array("features")).alias("pos", "value"))


@query("one_hot", ["incidents"], "SELECT row_id, " + ", ".join(
    [f"CAST(PdDistrict = 'D{i}' AS INTEGER) AS PD_D{i}" for i in range(10)]
    + [f"CAST(DayOfWeek = '{dname}' AS INTEGER) AS DAY_{dname}" for dname in
       ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]]) + " FROM incidents")
def one_hot(spark, d):
    """FE5: one column per observed district and weekday."""
    i = fx.incidents(spark, d).select("row_id", "PdDistrict", "DayOfWeek")
    return E.one_hot(E.one_hot(i, "PdDistrict", "PD", drop_source=True), "DayOfWeek", "DAY", drop_source=True)


_LOGODDS = _TR + """,
n AS (SELECT count(*) AS N FROM tr),
c AS (SELECT Category, count(*) AS cc FROM tr GROUP BY Category),
ci AS (SELECT Category, row_number() OVER (ORDER BY Category) - 1 AS k,
              CASE WHEN cc < N THEN ln(cc / N) - ln(1 - cc / N) END AS prior FROM c, n),
a AS (SELECT Address, count(*) AS ac FROM tr GROUP BY Address),
pc AS (SELECT Address, Category, count(*) AS pc FROM tr GROUP BY Address, Category),
grid AS (SELECT a.Address, ci.k,
                CASE WHEN pc.pc > {m} AND pc.pc < a.ac THEN ln(pc.pc / a.ac) - ln(1 - pc.pc / a.ac)
                     ELSE ci.prior END AS lo
         FROM a CROSS JOIN ci LEFT JOIN pc ON pc.Address = a.Address AND pc.Category = ci.Category)
SELECT Address, """ + ", ".join(f"max(CASE WHEN k = {k} THEN lo END) AS logodds{k}" for k in range(5)) + " FROM grid GROUP BY Address"


@query("target_log_odds", ["incidents"], _LOGODDS.replace("{m}", "15"))
def target_log_odds(spark, d):
    """FE6: per-address log-odds per category (pair count > 15 and below the address
    total, else the category prior), in sorted category order."""
    tr = fx.incidents(spark, d).where(F.col("split") == "train")
    lo, prior = E.fit_target_log_odds(tr, "Address", "Category", 15, "logodds")
    return E.widen(lo, "logodds", E.n_classes(prior))


@query("freq_log_odds", ["incidents"], _TR + """,
n AS (SELECT count(*) AS N FROM tr)
SELECT Address, CASE WHEN count(*) < max(N) THEN ln(count(*) / max(N)) - ln(1 - count(*) / max(N)) END AS logoddsPA
FROM tr, n GROUP BY Address""")
def freq_log_odds(spark, d):
    """FE7: log-odds of each address's share of the train rows."""
    tr = fx.incidents(spark, d).where(F.col("split") == "train")
    return E.fit_freq_log_odds(tr, "Address").select("Address", "logoddsPA")


@query("freq_log_odds_update", ["incidents"], _TR + """,
no AS (SELECT count(*) AS N FROM tr), nn AS (SELECT count(*) AS N FROM te),
ao AS (SELECT Address, count(*) AS c FROM tr GROUP BY Address),
an AS (SELECT Address, count(*) AS c FROM te GROUP BY Address),
j AS (SELECT coalesce(ao.Address, an.Address) AS Address,
             CASE WHEN ao.c IS NULL THEN an.c / (no.N + nn.N)
                  WHEN an.c IS NULL THEN ao.c / no.N
                  ELSE (ao.c + an.c) / (no.N + nn.N) END AS p
      FROM ao FULL OUTER JOIN an ON ao.Address = an.Address CROSS JOIN no CROSS JOIN nn)
SELECT Address, CASE WHEN p > 0 AND p < 1 THEN ln(p) - ln(1 - p) END AS logoddsPA FROM j""")
def freq_log_odds_update(spark, d):
    """FE8: frequencies pooled over train and test; new addresses over the pooled total."""
    i = fx.incidents(spark, d)
    return E.update_freq_log_odds(i.where(F.col("split") == "train"), i.where(F.col("split") == "test"), "Address")


@query("label_index", ["incidents"], """
SELECT Category, CAST(row_number() OVER (ORDER BY Category) - 1 AS INTEGER) AS label_idx
FROM (SELECT DISTINCT Category FROM incidents) c""")
def label_index(spark, d):
    """FE9: category -> index in sorted order."""
    return E.label_index(fx.incidents(spark, d), "Category")


_ANOVA = """
g AS (SELECT l_returnflag AS c, count(*) AS n,
             sum(l_quantity) AS s0, sum(l_quantity * l_quantity) AS q0,
             sum(l_discount) AS s1, sum(l_discount * l_discount) AS q1,
             sum(l_tax) AS s2, sum(l_tax * l_tax) AS q2 FROM lineitem GROUP BY l_returnflag),
l AS (SELECT 'l_quantity' AS feature, n, s0 AS s, q0 AS q FROM g UNION ALL
      SELECT 'l_discount', n, s1, q1 FROM g UNION ALL SELECT 'l_tax', n, s2, q2 FROM g),
t AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM l GROUP BY feature),
f AS (SELECT feature, ((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)) AS f_value FROM t)
"""

_ANOVA_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query("anova_f", None, _ANOVA + "SELECT feature, f_value FROM f")
def anova_f(spark, d):
    """FE11: one-way ANOVA F of three line measures against the return flag."""
    li = table(spark, d, "lineitem")
    return E.anova_f(li, _ANOVA_FEATURES, "l_returnflag").select("feature", "f_value")


@query("topk_scores", None, _ANOVA + "SELECT feature, f_value FROM f ORDER BY f_value DESC, feature LIMIT 2")
def topk_scores(spark, d):
    """SO4: the two features with the largest F."""
    li = table(spark, d, "lineitem")
    return R.topk(E.anova_f(li, _ANOVA_FEATURES, "l_returnflag").select("feature", "f_value"), "f_value", "feature", 2)


@query("select_k_best", None, _ANOVA + "SELECT feature, f_value FROM f ORDER BY f_value DESC, feature LIMIT 2")
def select_k_best(spark, d):
    """FE12: the best two of three line measures by ANOVA F against the return flag."""
    li = table(spark, d, "lineitem")
    return E.select_k_best(li, _ANOVA_FEATURES, "l_returnflag", 2).select("feature", "f_value")


@query("select_k_best_scores")
def select_k_best_scores(spark, d):
    """FE12: five best of the bidder predictors by ANOVA F against the outcome,
    with p-values and -log10 scores (rows-only: p-values need the F distribution)."""
    feats = BD.bidder_features(fx.bids(spark, d), fx.bidders(spark, d), "train").checkpoint()
    scores = E.anova_scores(feats, BD.PREDICTORS, "outcome")
    best = E.select_k_best(feats, BD.PREDICTORS, "outcome", 5).select("feature")
    return scores.join(best, "feature", "left_semi")


@query("assemble_features")
def assemble_features(spark, d):
    """FE10: named predictor columns -> one MLlib vector column (rows-only)."""
    from ...operators.model import assemble
    feats = BD.bidder_features(fx.bids(spark, d), fx.bidders(spark, d), "train")
    return assemble(feats, BD.PREDICTORS).select("bidder_id", "features")


#: Components of the PCA, as many as the reference's; a shorter vector has all of its own.
PCA_K = 200


def _pca(spark, d):
    from ...operators.model import pca_project as pca
    dg = fx.digits(spark, d)
    return pca(dg, "px", min(PCA_K, E.common_length(dg, "px")))


@query("pca_project")
def pca_project(spark, d):
    """FE4: PCA of the standardised pixels to 200 components or, if there are fewer pixels, to all
    (rows-only; ``pca_norms`` and ``pca_variances`` have SQL)."""
    return _pca(spark, d)[0].select("row_id", "pca")


_PIXELS = """
e AS (SELECT row_id, unnest(px) AS x, generate_subscripts(px, 1) AS i FROM digits),
s AS (SELECT i, avg(x) AS m, stddev_samp(x) AS sd FROM e GROUP BY i),
z AS (SELECT e.row_id, e.i, (e.x - s.m) / CASE WHEN s.sd = 0 OR s.sd IS NULL THEN 1 ELSE s.sd END AS v FROM e JOIN s USING (i))
"""


@query("pca_norms", ["digits"], _PIXELS + "SELECT row_id, sum(v * v) AS square_length FROM z GROUP BY row_id")
def pca_norms(spark, d):
    """FE4: a rotation keeps lengths, so with all components a row's squares add up to those of its standardised pixels."""
    squares = F.aggregate("pca", F.lit(0.0), lambda a, x: a + x * x)
    return _pca(spark, d)[0].select("row_id", squares.alias("square_length"))


@query("pca_variances", ["digits"], _PIXELS + """,
c AS (SELECT a.i, b.i AS j, sum(a.v * b.v) / (SELECT count(*) - 1 FROM digits) AS cov
      FROM z a JOIN z b USING (row_id) GROUP BY a.i, b.i)
SELECT sum(CASE WHEN i = j THEN cov ELSE 0 END) AS variance, sum(cov * cov) AS square_sum FROM c""")
def pca_variances(spark, d):
    """FE4: the components' variances add up to the trace of the covariance matrix, their squares to its squared entries."""
    out, _ = _pca(spark, d)
    per = out.select(F.posexplode("pca").alias("k", "v")).groupBy("k").agg(F.var_samp("v").alias("v"))
    return per.agg(F.sum("v").alias("variance"), F.sum(F.col("v") * F.col("v")).alias("square_sum"))
