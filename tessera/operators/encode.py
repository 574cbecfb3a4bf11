"""Feature encoders: ``fit(df) -> small model DataFrame``, ``transform(df, model)`` (FE1-FE13).

Fitted state is a DataFrame (one row, or one row per key), joined in at
transform time. The driver only reads what its output is as wide as: category lists
for one column per category, one row per feature, column lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import log_odds
from .ids import row_number_global
from .relate import with_row


# ---------------------------------------------------------------- scaling

def fit_standardizer(df: DataFrame, cols: Sequence[str], population: bool = True) -> DataFrame:
    """FE1/FE2 fit: one row with ``<c>_mean`` and ``<c>_std`` (population or sample)."""
    sd = F.stddev_pop if population else F.stddev_samp
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), sd(c).alias(f"{c}_std")]
    return df.agg(*aggs)


def apply_standardizer(df: DataFrame, stats: DataFrame, cols: Sequence[str], zero_std_to_one: bool = True) -> DataFrame:
    """FE1/FE2 transform: (x - mean) / std with the fitted one-row frame (broadcast)."""
    j = with_row(df, stats)
    out = {}
    for c in cols:
        s = F.col(f"{c}_std")
        if zero_std_to_one:
            s = F.when((s == 0) | s.isNull(), F.lit(1.0)).otherwise(s)
        out[c] = (F.col(c) - F.col(f"{c}_mean")) / s
    return j.withColumns(out).drop(*stats.columns)


def standardize_pop(fit_on: DataFrame, apply_to: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE1: population std, fitted on one table and applied to another."""
    return apply_standardizer(apply_to, fit_standardizer(fit_on, cols, True), cols)


def standardize_samp(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE2: sample std; zero std replaced by 1."""
    return apply_standardizer(df, fit_standardizer(df, cols, False), cols)


def constant_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """FE3 helper: names of columns whose sample std is 0 (one bounded row read)."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] == 0]


def drop_constant_columns(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """FE3: drop zero-variance columns, standardise the rest (sample std)."""
    const = constant_columns(df, cols)
    keep = [c for c in cols if c not in const]
    return standardize_samp(df.drop(*const), keep), keep


# ---------------------------------------------------------------- categories

def categories(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values. For output that has a column per value:
    the read is as wide as that output."""
    return sorted(r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().collect())


def one_hot(df: DataFrame, col: str, prefix: str, cats: Sequence | None = None,
            drop_source: bool = False) -> DataFrame:
    """FE5: one 0/1 column ``<prefix>_<value>`` per category fixed at fit; unseen -> all 0."""
    cats = categories(df, col) if cats is None else list(cats)
    out = df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v in cats})
    return out.drop(col) if drop_source else out


def label_index(df: DataFrame, col: str, out: str = "label_idx") -> DataFrame:
    """FE9: class -> 0-based index in sorted order (one row per class)."""
    d = df.where(F.col(col).isNotNull()).select(col).distinct()
    return row_number_global(d, [col], "_i").select(col, (F.col("_i") - 1).cast("int").alias(out))


# ---------------------------------------------------------------- log-odds encodings

def fit_freq_log_odds(df: DataFrame, key: str, out: str = "logoddsPA") -> DataFrame:
    """FE7: per key, log-odds of its share of the rows; also keeps the count."""
    n = df.agg(F.count(F.lit(1)).alias("_N"))
    a = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_ac"))
    return (with_row(a, n)
            .select(key, "_ac", "_N", log_odds(F.col("_ac") / F.col("_N")).alias(out)))


def update_freq_log_odds(old: DataFrame, new: DataFrame, key: str, out: str = "logoddsPA") -> DataFrame:
    """FE8: log-odds frequencies after seeing a new table.

    Keys only in the new table: new count / (old rows + new rows). Keys in
    both: pooled count / pooled rows. Keys only in the old table keep the old
    value (old count / old rows).
    """
    n_old = old.agg(F.count(F.lit(1)).alias("_No"))
    n_new = new.agg(F.count(F.lit(1)).alias("_Nn"))
    a_old = old.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_ao"))
    a_new = new.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_an"))
    j = with_row(with_row(a_old.join(a_new, key, "full_outer"), n_old), n_new)
    pooled = F.col("_No") + F.col("_Nn")
    p = (F.when(F.col("_ao").isNull(), F.col("_an") / pooled)
         .when(F.col("_an").isNull(), F.col("_ao") / F.col("_No"))
         .otherwise((F.col("_ao") + F.col("_an")) / pooled))
    return j.select(key, log_odds(p).alias(out))


def fit_target_log_odds(df: DataFrame, key: str, label: str, min_count: int = 2,
                        out: str = "logodds") -> tuple[DataFrame, DataFrame]:
    """FE6 fit. Returns (per-key table ``key, out: array<double>``, prior row).

    Entry k of the array is for the k-th class in sorted order: the
    within-key log-odds of the class when its pair count is above
    ``min_count`` and below the key's total; otherwise the class prior
    log-odds. The prior vector is one row (length = number of classes) and is
    broadcast. Each key keeps at most one entry per class, so no key x class
    grid is materialised. Classes are indexed by a join with ``label_index``,
    not by a list on the driver.
    """
    d = df.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    idx = label_index(d, label, "_k")
    n = d.agg(F.count(F.lit(1)).alias("_N"))
    cls = (with_row(d.groupBy(label).agg(F.count(F.lit(1)).alias("_cc")), n).join(idx, label)
           .select("_k", log_odds(F.col("_cc") / F.col("_N")).alias("_prior")))
    prior = cls.agg(F.sort_array(F.collect_list(F.struct("_k", "_prior"))).alias("_p")).select(
        F.transform("_p", lambda s: s["_prior"]).alias("_prior"))  # one row, one entry per class
    a = d.groupBy(key).agg(F.count(F.lit(1)).alias("_ac"))
    pc = d.groupBy(key, label).agg(F.count(F.lit(1)).alias("_pc"))
    q = (pc.join(a, key)
         .where((F.col("_pc") > min_count) & (F.col("_pc") < F.col("_ac"))).join(idx, label)
         .select(key, "_k", log_odds(F.col("_pc") / F.col("_ac")).alias("_lo")))
    over = q.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_lo"))).alias("_m"))
    keys = with_row(a.select(key).join(over, key, "left"), prior)
    vec = F.transform("_prior", lambda p, i: F.coalesce(F.col("_m")[i], p))
    return keys.select(key, vec.alias(out)), prior


def n_classes(prior: DataFrame) -> int:
    """Number of classes of a fitted prior row."""
    return int(prior.select(F.size("_prior")).first()[0])


def apply_target_log_odds(df: DataFrame, table: DataFrame, prior: DataFrame, key: str,
                          out: str = "logodds") -> DataFrame:
    """FE6/FE8 transform: per-row vector; keys absent from the table get the prior."""
    j = with_row(df.join(table, key, "left"), prior)
    return j.withColumn(out, F.coalesce(F.col(out), F.col("_prior"))).drop("_prior")


def widen(df: DataFrame, col: str, n: int, prefix: str | None = None) -> DataFrame:
    """Array column -> ``<prefix>0..<prefix>n-1`` columns."""
    prefix = prefix or col
    return df.withColumns({f"{prefix}{i}": F.col(col)[i] for i in range(n)}).drop(col)


# ---------------------------------------------------------------- ANOVA F

def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """FE11: one-way ANOVA F value of each feature against the class label.

    One grouped aggregate (count, mean and population variance of the non-null
    values per class and feature) reduces the data to (classes x features)
    numbers; F follows from these in a second, tiny aggregate. Sums of squares
    are taken about the means, so a large common offset cancels nothing.
    Result: (feature, f_value, df_between, df_within).
    """
    col = {f: F.col(f).cast("double") for f in features}
    per = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.count(c).alias(f"_n_{i}") for i, c in enumerate(col.values())],
        *[F.avg(c).alias(f"_m_{i}") for i, c in enumerate(col.values())],
        *[F.var_pop(c).alias(f"_v_{i}") for i, c in enumerate(col.values())])
    long = per.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_n_{i}").alias("n"), F.col(f"_m_{i}").alias("m"),
                 F.col(f"_v_{i}").alias("v")) for i, f in enumerate(features)])).alias("_e"))
    long = long.select("_e.*").where(F.col("n") > 0)
    low = long.groupBy("feature").agg(F.min("m").alias("_low"))
    long = long.join(low, "feature").withColumn("d", F.col("m") - F.col("_low"))
    mean = long.groupBy("feature").agg((F.sum(F.col("n") * F.col("d")) / F.sum("n")).alias("_mean"))
    g = long.join(mean, "feature").groupBy("feature").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (F.col("d") - F.col("_mean")) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    dfb = F.col("k") - 1
    dfw = F.col("n") - F.col("k")
    return g.select("feature", F.try_divide(F.try_divide(F.col("between"), dfb),
                                            F.try_divide(F.col("within"), dfw)).alias("f_value"),
                    dfb.alias("df_between"), dfw.alias("df_within"))


def f_survival(spark: SparkSession, f: float | None, d1: int, d2: int) -> float | None:
    """P(F > f) by the JVM's special functions.

    Beyond 1e9 degrees within, the incomplete beta function loses digits, while
    the chi-square limit is right to one part in d2.
    """
    if f is None or d1 <= 0 or d2 <= 0:
        return None
    special = spark._jvm.org.apache.commons.math3.special
    if d2 > 1e9:
        return float(special.Gamma.regularizedGammaQ(d1 / 2.0, d1 * f / 2.0))
    return float(special.Beta.regularizedBeta(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0))


def anova_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """FE11 + SC12: F value, p-value and -log10(p) per feature.

    The p-value comes from the JVM's incomplete beta function (Commons Math,
    part of Spark), on the driver: one row per feature.
    """
    spark = df.sparkSession
    rows = [(r["feature"], r["f_value"], r["df_between"], r["df_within"],
             f_survival(spark, r["f_value"], r["df_between"], r["df_within"]))
            for r in anova_f(df, features, label).collect()]
    out = spark.createDataFrame(rows, "feature string, f_value double, df_between long, df_within long, p_value double")
    return out.withColumn("score", F.when(F.col("p_value") > 0, -F.log10("p_value")))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int) -> DataFrame:
    """FE12: the k features with the largest F value (ties by name)."""
    a = anova_f(df, features, label)
    return a.orderBy(F.col("f_value").desc_nulls_last(), F.col("feature")).limit(k)


def kbest_selector(k: int, features: str = "features", label: str = "label", out: str = "selected"):
    """FE12 pipeline form: MLlib selector keeping the k features with the best
    ANOVA F test against a categorical label (vector column in and out)."""
    from pyspark.ml.feature import UnivariateFeatureSelector
    return (UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=out,
                                      selectionMode="numTopFeatures")
            .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k))


def variance_selector(features: str = "features", out: str = "selected", threshold: float = 0.0):
    """FE3 pipeline form: drop vector slots whose sample variance is not above ``threshold``."""
    from pyspark.ml.feature import VarianceThresholdSelector
    return VarianceThresholdSelector(featuresCol=features, outputCol=out, varianceThreshold=threshold)


def standardized_vectors(df: DataFrame, col: str, out: str = "features", drop_constant: bool = True) -> DataFrame:
    """FE2 (+FE3) on every element of an array column, by MLlib's vector scaler and selector.

    Sample standard deviation, all rows together (A14); an element without
    variance is dropped (or 0, if kept). All arrays must have one length.
    """
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    common_length(df, col)
    v = df.withColumn("_raw", array_to_vector(F.transform(col, lambda x: x.cast("double"))))
    src = "_raw"
    if drop_constant:
        v = variance_selector("_raw", "_var").fit(v).transform(v)
        src = "_var"
    v = StandardScaler(withMean=True, withStd=True, inputCol=src, outputCol=out).fit(v).transform(v)
    return v.drop("_raw", "_var")


def common_length(df: DataFrame, col: str) -> int:
    """The one length of all arrays of a column; an error if they differ (one row read)."""
    r = df.agg(F.min(F.size(col)).alias("a"), F.max(F.size(col)).alias("b")).first()
    if r["a"] != r["b"]:
        raise ValueError(f"{col}: arrays of {r['a']} to {r['b']} elements")
    return int(r["a"] or 0)
