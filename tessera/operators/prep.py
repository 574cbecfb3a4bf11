"""Projections, filters, casts, recodes and fills (PR1-PR18).

Every function maps a DataFrame to a DataFrame and names its columns by
parameter. Statistics used for fills stay DataFrames (one row, or one row per
key) and are joined in, so no value goes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import exact_median
from .relate import with_row


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PR1."""
    return df.select(*cols)


def column_range(df: DataFrame, start: str | None = None, end: str | None = None,
                 skip_first: int = 0) -> list[str]:
    """PR2: names from ``start`` to ``end`` inclusive (pandas ``loc[:, a:b]``), or all
    but the first ``skip_first`` (pandas ``iloc[:, k:]``)."""
    names = df.columns[skip_first:]
    i = names.index(start) if start else 0
    j = names.index(end) + 1 if end else len(names)
    return names[i:j]


def select_range(df: DataFrame, start: str | None = None, end: str | None = None,
                 skip_first: int = 0, as_array: str | None = None) -> DataFrame:
    """PR2: select a column range; with ``as_array`` pack it into one array column."""
    cols = column_range(df, start, end, skip_first)
    if as_array:
        return df.select(F.array(*cols).alias(as_array))
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PR3: absent names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PR4."""
    return df.withColumnsRenamed(dict(mapping))


def ratio(num: str | Column, den: str | Column) -> Column:
    """PR5: division that gives NULL for a zero denominator (A4)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num, den)


def with_columns(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """PR5/PR6: derived, constant or copied columns in one projection."""
    return df.withColumns(dict(cols))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """PR7: cast named columns; ``strict=False`` turns bad values into NULL."""
    f = (lambda c, t: F.col(c).cast(t)) if strict else (lambda c, t: F.col(c).try_cast(t))
    return df.withColumns({c: f(c, t) for c, t in types.items()})


def filter_rows(df: DataFrame, cond: Column | str) -> DataFrame:
    """PR8."""
    return df.where(cond)


def null_split(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """PR9: (rows where col is known, rows where it is NULL)."""
    return df.where(F.col(col).isNotNull()), df.where(F.col(col).isNull())


def conditional_update(df: DataFrame, col: str, cond: Column, value, out: str | None = None) -> DataFrame:
    """PR10: ``loc[cond, col] = value``; a NULL condition keeps the old value (A5)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(out or col, F.when(F.coalesce(cond, F.lit(False)), v).otherwise(F.col(col)))


def clamp_outliers(df: DataFrame, cols: Sequence[str], limit: float = 5.0, value: float = 0.0) -> DataFrame:
    """PR12: values with abs > limit replaced by ``value``."""
    return df.withColumns({c: F.when(F.abs(c) > limit, F.lit(value)).otherwise(F.col(c)) for c in cols})


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """PR13: per-column NULL fill."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_with_stat(df: DataFrame, col: str, stat: DataFrame, stat_col: str) -> DataFrame:
    """PR14: fill NULLs from a one-row statistics frame, cross-joined (broadcast of one row)."""
    s = stat.select(F.col(stat_col).alias("_fill"))
    return (with_row(df, s)
            .withColumn(col, F.coalesce(F.col(col), F.col("_fill").cast(df.schema[col].dataType)))
            .drop("_fill"))


def fill_global_median(df: DataFrame, col: str) -> DataFrame:
    """PR14: NULL -> median of the column over the whole table."""
    return fill_with_stat(df, col, exact_median(df, col, out="_m"), "_m")


def fill_global_max(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """PR14: NULL -> maximum of another table's column."""
    return fill_with_stat(df, col, other.agg(F.max(other_col).alias("_mx")), "_mx")


def fill_group_median(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """PR15: NULL -> median of the row's group; an all-NULL group stays NULL.

    The per-group medians are a small keyed frame joined back (AQE broadcasts
    it when its runtime size allows, otherwise a shuffle join).
    """
    med = exact_median(df, col, by, out="_gm")
    return (df.join(med, list(by), "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_gm")))
            .drop("_gm"))


def impute_regression(df: DataFrame, target: str, predictors: Sequence[str], out: str | None = None,
                      fill: bool = True) -> DataFrame:
    """PR16: linear regression fitted on rows where ``target`` is known, predicted
    for the missing ones (MLlib, distributed). With ``fill=False`` the
    prediction goes to ``out`` only (the reference fits it and discards it).
    Rows with a missing predictor are not fitted on and get no prediction."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    out = out or f"{target}_pred"
    va = VectorAssembler(inputCols=list(predictors), outputCol="_x", handleInvalid="keep")
    whole = F.lit(True)
    for c in predictors:
        whole = whole & F.col(c).isNotNull()
    known = va.transform(df.where(F.col(target).isNotNull() & whole))
    model = LinearRegression(featuresCol="_x", labelCol=target, predictionCol=out, regParam=0.0,
                             solver="normal").fit(known)
    res = model.transform(va.transform(df)).drop("_x")
    res = res.withColumn(out, F.when(whole, F.col(out)))
    if fill:
        res = res.withColumn(target, F.coalesce(F.col(target), F.col(out)))
    return res


def impute_regression_1d(df: DataFrame, target: str, predictor: str, out: str) -> DataFrame:
    """PR16 single-predictor form: least-squares line by ``regr_slope``/``regr_intercept``
    over the known rows (a one-row aggregate), applied to every row."""
    coef = df.agg(F.regr_slope(target, predictor).alias("_b"),
                  F.regr_intercept(target, predictor).alias("_a"))
    return (with_row(df, coef)
            .withColumn(out, F.col("_a") + F.col("_b") * F.col(predictor))
            .drop("_a", "_b"))


def recode_map(col: str | Column, mapping: Mapping[str, int], default: int | None = 0) -> Column:
    """PR17: many-to-one recode by a fixed map; unmatched -> ``default`` (A6)."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    looked = m[c]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def recode_small(col: str | Column, cases: Sequence[tuple[object, object]], otherwise=None) -> Column:
    """PR18: short ``when`` chain (binary/ternary recodes)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in cases:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
