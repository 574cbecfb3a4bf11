"""Registered queries: prep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...operators import prep as P
from ...functions import scalar as S
from .. import passengers as PS

_TITLE_CASE = """CASE regexp_extract(Name, ' ([A-Za-z]+)\\.', 1)
  WHEN 'Mr' THEN 1 WHEN 'Miss' THEN 2 WHEN 'Mrs' THEN 3 WHEN 'Master' THEN 4 WHEN 'Dr' THEN 5
  WHEN 'Rev' THEN 6 WHEN 'Major' THEN 7 WHEN 'Col' THEN 7 WHEN 'Mlle' THEN 8 WHEN 'Mme' THEN 8
  WHEN 'Don' THEN 9 WHEN 'Dona' THEN 10 WHEN 'Lady' THEN 10 WHEN 'Countess' THEN 10
  WHEN 'Jonkheer' THEN 10 WHEN 'Sir' THEN 9 WHEN 'Capt' THEN 7 WHEN 'Ms' THEN 2 ELSE 0 END"""


@query("select_columns", ["passengers"], "SELECT PassengerId, Name, Sex, Age FROM passengers")
def select_columns(spark, d):
    """PR1."""
    return P.select_columns(fx.passengers(spark, d), ["PassengerId", "Name", "Sex", "Age"])


@query("select_range", ["passengers"], "SELECT Name, Sex, Age, SibSp, Parch FROM passengers")
def select_range(spark, d):
    """PR2: columns Name..Parch by position."""
    return P.select_range(fx.passengers(spark, d), "Name", "Parch")


@query("drop_columns", ["incidents"],
       "SELECT row_id, Dates, split, Address, PdDistrict, DayOfWeek, X, Y FROM incidents")
def drop_columns(spark, d):
    """PR3: absent names (Descript, Resolution) are ignored."""
    return P.drop_columns(fx.incidents(spark, d), ["Descript", "Resolution", "Category", "Id"])


@query("rename_columns", ["bids"],
       "SELECT bidder_id, count(bid_id) AS nofbids, max(device) AS maxdev FROM bids GROUP BY bidder_id")
def rename_columns(spark, d):
    """PR4: rename aggregate outputs."""
    a = fx.bids(spark, d).groupBy("bidder_id").agg(F.count("bid_id"), F.max("device"))
    return P.rename_columns(a, {"count(bid_id)": "nofbids", "max(device)": "maxdev"})


@query("derived_columns", ["passengers"], """
SELECT row_id, SibSp + Parch AS FamilySize, Fare / nullif(SibSp + Parch, 0) AS FarePerHead,
       Fare - Age AS FareMinusAge
FROM passengers""")
def derived_columns(spark, d):
    """PR5: sum, difference and ratio (ratio NULL on a zero denominator, A4)."""
    p = fx.passengers(spark, d)
    fs = F.col("SibSp") + F.col("Parch")
    return p.select("row_id", fs.alias("FamilySize"), P.ratio(F.col("Fare"), fs).alias("FarePerHead"),
                    (F.col("Fare") - F.col("Age")).alias("FareMinusAge"))


@query("constant_columns", ["passengers"], "SELECT row_id, 0 AS Married, Name AS Name2 FROM passengers")
def constant_columns(spark, d):
    """PR6."""
    p = fx.passengers(spark, d)
    return P.with_columns(p, {"Married": F.lit(0), "Name2": F.col("Name")}).select("row_id", "Married", "Name2")


@query("cast_columns", ["passengers"], """
SELECT row_id, CAST(Sex = 'female' AS DOUBLE) AS SexF, CAST(Age AS INTEGER) AS AgeI,
       CAST(PassengerId AS VARCHAR) AS IdS, CAST(Fare AS FLOAT) AS Fare32, CAST(Survived AS DOUBLE) AS SurvivedD
FROM passengers""")
def cast_columns(spark, d):
    """PR7: bool->double, double->int (whole values), id->string, double->float, int->double."""
    p = fx.passengers(spark, d).withColumns({"SexF": F.col("Sex") == "female", "AgeI": F.col("Age"),
                                              "IdS": F.col("PassengerId"), "Fare32": F.col("Fare"),
                                              "SurvivedD": F.col("Survived")})
    return P.cast_columns(p, {"SexF": "double", "AgeI": "int", "IdS": "string", "Fare32": "float",
                              "SurvivedD": "double"}).select("row_id", "SexF", "AgeI", "IdS", "Fare32", "SurvivedD")


@query("filter_rows", ["incidents"], "SELECT row_id, X, Y FROM incidents WHERE abs(X) < 30 AND abs(Y) < 100")
def filter_rows(spark, d):
    """PR8 + SC13."""
    return P.filter_rows(fx.incidents(spark, d), (F.abs("X") < 30) & (F.abs("Y") < 100)).select("row_id", "X", "Y")


@query("null_split", ["passengers"], """
SELECT row_id, Age, 'known' AS part FROM passengers WHERE Age IS NOT NULL
UNION ALL
SELECT row_id, Age, 'missing' AS part FROM passengers WHERE Age IS NULL""")
def null_split(spark, d):
    """PR9: rows with a known Age and rows where it is missing, tagged."""
    known, missing = P.null_split(fx.passengers(spark, d).select("row_id", "Age"), "Age")
    return known.withColumn("part", F.lit("known")).unionByName(missing.withColumn("part", F.lit("missing")))


@query("conditional_update", ["passengers"], """
SELECT row_id,
       CASE WHEN coalesce(Age < 18, false) THEN 1 ELSE 0 END AS child,
       CASE WHEN coalesce((SibSp > 0 OR Parch > 1) AND (Sex = 'female' OR Age < 18), false) THEN 1 ELSE 0 END AS flag
FROM passengers""")
def conditional_update(spark, d):
    """PR10: ``loc[mask, col] = 1`` with plain and AND/OR masks; NULL masks keep 0 (A5)."""
    p = fx.passengers(spark, d).withColumns({"child": F.lit(0), "flag": F.lit(0)})
    p = P.conditional_update(p, "child", F.col("Age") < 18, 1)
    mask = ((F.col("SibSp") > 0) | (F.col("Parch") > 1)) & ((F.col("Sex") == "female") | (F.col("Age") < 18))
    p = P.conditional_update(p, "flag", mask, 1)
    return p.select("row_id", "child", "flag")


@query("season_flags", None, """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS Month,
       CAST(month(o_orderdate) IN (5, 6, 7) AS INTEGER) AS Summer,
       CAST(month(o_orderdate) IN (8, 9, 10) AS INTEGER) AS Fall,
       CAST(month(o_orderdate) IN (11, 0, 1) AS INTEGER) AS Winter,
       CAST(month(o_orderdate) IN (2, 3, 4) AS INTEGER) AS Spring
FROM orders""")
def season_flags(spark, d):
    """PR11/SC10: month membership flags (December gets none, A8)."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.month("o_orderdate").alias("Month"),
                    *[c.alias(n) for n, c in S.season_flags(F.month("o_orderdate")).items()])


@query("outlier_clamp", ["incidents"], """
SELECT row_id, CASE WHEN abs(X) > 30 THEN 0.0 ELSE X END AS X,
       CASE WHEN abs(Y) > 30 THEN 0.0 ELSE Y END AS Y FROM incidents""")
def outlier_clamp(spark, d):
    """PR12: values beyond the limit set to 0."""
    return P.clamp_outliers(fx.incidents(spark, d), ["X", "Y"], 30.0, 0.0).select("row_id", "X", "Y")


@query("fill_constant", ["passengers"], """
SELECT row_id, coalesce(Embarked, 'S') AS Embarked, coalesce(Cabin, 'UNK') AS Cabin,
       coalesce(Survived, 0) AS Survived FROM passengers""")
def fill_constant(spark, d):
    """PR13."""
    p = P.fill_constant(fx.passengers(spark, d), {"Embarked": "S", "Cabin": "UNK", "Survived": 0})
    return p.select("row_id", "Embarked", "Cabin", "Survived")


@query("fill_global_stat", ["passengers"], """
SELECT row_id, coalesce(Fare, (SELECT median(Fare) FROM passengers)) AS Fare,
       coalesce(Age, (SELECT max(p_retailprice) FROM part)) AS AgeOrMaxPrice
FROM passengers""")
def fill_global_stat(spark, d):
    """PR14: NULL -> global median; NULL -> maximum of another table's column."""
    p = fx.passengers(spark, d)
    p = P.fill_global_median(p, "Fare")
    p = p.withColumn("AgeOrMaxPrice", F.col("Age"))
    p = P.fill_global_max(p, "AgeOrMaxPrice", table(spark, d, "part"), "p_retailprice")
    return p.select("row_id", "Fare", "AgeOrMaxPrice")


@query("fill_group_median", ["passengers"], """
t AS (SELECT row_id, Age, regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) AS TitleWord FROM passengers),
m AS (SELECT TitleWord, median(Age) AS med FROM t WHERE Age IS NOT NULL GROUP BY TitleWord)
SELECT row_id, t.TitleWord, coalesce(Age, med) AS Age FROM t LEFT JOIN m USING (TitleWord)""")
def fill_group_median(spark, d):
    """PR15: NULL Age -> median of its title group; the all-NULL group stays NULL."""
    p = fx.passengers(spark, d).select("row_id", "Age", S.regex_group("Name").alias("TitleWord"))
    return P.fill_group_median(p, "Age", ["TitleWord"]).select("row_id", "TitleWord", "Age")


@query("impute_regression", ["passengers"], """
c AS (SELECT regr_slope(Age, Fare) AS b, regr_intercept(Age, Fare) AS a FROM passengers)
SELECT row_id, a + b * Fare AS AgePred, coalesce(Age, a + b * Fare) AS Age FROM passengers, c""")
def impute_regression(spark, d):
    """PR16 single-predictor form: Age on Fare by least squares over known rows."""
    p = fx.passengers(spark, d)
    p = P.impute_regression_1d(p, "Age", "Fare", "AgePred")
    return p.select("row_id", "AgePred", F.coalesce("Age", "AgePred").alias("Age"))


@query("recode_map", ["passengers"], f"""
SELECT row_id, regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) AS TitleWord, {_TITLE_CASE} AS Title,
       CASE regexp_extract(coalesce(Cabin, 'UNK'), '^[A-Z]+', 0)
         WHEN 'UNK' THEN 1 WHEN 'C' THEN 2 WHEN 'B' THEN 3 WHEN 'D' THEN 4 WHEN 'E' THEN 5
         WHEN 'A' THEN 6 WHEN 'F' THEN 7 WHEN 'G' THEN 8 WHEN 'T' THEN 9 ELSE 0 END AS CabinLetter
FROM passengers""")
def recode_map(spark, d):
    """PR17: title and deck letter codes by fixed maps; unmatched -> 0 (A6)."""
    p = fx.passengers(spark, d)
    return p.select("row_id", S.regex_group("Name").alias("TitleWord"), PS.title_code("Name").alias("Title"),
                    PS.deck_code(F.coalesce("Cabin", F.lit("UNK"))).alias("CabinLetter"))


@query("recode_small", ["passengers"], """
SELECT row_id, CASE WHEN Sex = 'male' THEN 0 WHEN Sex = 'female' THEN 1 END AS Sex,
       CASE coalesce(Embarked, 'S') WHEN 'S' THEN 0 WHEN 'C' THEN 1 WHEN 'Q' THEN 2 END AS Embarked
FROM passengers""")
def recode_small(spark, d):
    """PR18: binary and ternary recodes."""
    p = fx.passengers(spark, d)
    return p.select("row_id", PS.sex_code("Sex").alias("Sex"), PS.embarked_code("Embarked").alias("Embarked"))
