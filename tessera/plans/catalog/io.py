"""Registered queries: io."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ..registry import query
from ...sources import csvio as IO
from ...operators import encode as E
from ...operators.relate import with_row

_PASSENGER_SCHEMA = ("row_id BIGINT, PassengerId BIGINT, split STRING, Survived INT, Name STRING, Sex STRING, "
                     "Age DOUBLE, SibSp INT, Parch INT, Pclass INT, Fare DOUBLE, Cabin STRING, Embarked STRING")


@query("scan_csv", ["passengers"], "SELECT * FROM passengers")
def scan_csv(spark, d):
    """IO1: the passengers view written as CSV and scanned back with its schema."""
    path = IO.write_csv(fx.passengers(spark, d), IO.scratch_dir(spark, "scan_csv"))
    return IO.scan_csv(spark, path, _PASSENGER_SCHEMA)


@query("sink_csv", ["bidders"], "SELECT bidder_id, CAST(outcome AS INTEGER) AS predictions FROM bidders WHERE split = 'test'")
def sink_csv(spark, d):
    """IO2: a submission written without index and read back."""
    sub = IO.submission(fx.bidders(spark, d).where(F.col("split") == "test"), "bidder_id", "outcome",
                        out_pred="predictions")
    path = IO.write_csv(sub, IO.scratch_dir(spark, "sink_csv"))
    return IO.scan_csv(spark, path, "bidder_id BIGINT, predictions INT")


@query("sink_csv_indexed", ["incidents"], """
SELECT CAST(row_number() OVER (ORDER BY row_id) - 1 AS BIGINT) AS Id, Category,
       coalesce(CASE WHEN X > 20 THEN X END, 0) AS X
FROM incidents WHERE split = 'test'""")
def sink_csv_indexed(spark, d):
    """IO3: 0-based index column 'Id', NULLs written as '0', read back."""
    t = (fx.incidents(spark, d).where(F.col("split") == "test")
         .select("row_id", "Category", F.when(F.col("X") > 20, F.col("X")).alias("X")))
    path = IO.write_csv_indexed(t, IO.scratch_dir(spark, "sink_csv_indexed"), ["row_id"], "Id", "0")
    return IO.scan_csv(spark, path, "Id BIGINT, Category STRING, X DOUBLE")


@query("submission_narrow", ["passengers"], """
SELECT PassengerId, CAST(coalesce(Fare, 0) > 1500 AS INTEGER) AS Survived FROM passengers WHERE split = 'test'""")
def submission_narrow(spark, d):
    """IO4: id + integer prediction from a fixed score."""
    p = fx.passengers(spark, d).where(F.col("split") == "test")
    return IO.submission(p.withColumn("s", F.coalesce("Fare", F.lit(0.0)) > 1500), "PassengerId", "s",
                         out_pred="Survived")


@query("submission_wide", ["incidents"], """
tr AS (SELECT * FROM incidents WHERE split = 'train'),
pr AS (SELECT Category, count(*) / (SELECT count(*) FROM tr) AS p FROM tr GROUP BY Category)
SELECT Id, """ + ", ".join(f"(SELECT p FROM pr WHERE Category = '{c}') AS {c}"
                           for c in ["click", "error", "purchase", "signup", "view"]) + """
FROM incidents WHERE split = 'test'""")
def submission_wide(spark, d):
    """IO5: one column per sorted class holding the class prior probability."""
    inc = fx.incidents(spark, d)
    tr = inc.where(F.col("split") == "train")
    classes = E.categories(tr, "Category")
    n = tr.agg(F.count(F.lit(1)).alias("_n"))
    pri = (with_row(tr.groupBy("Category").agg(F.count(F.lit(1)).alias("_c")), n)
           .agg(F.map_from_entries(F.collect_list(F.struct("Category", F.col("_c") / F.col("_n")))).alias("_m")))
    te = with_row(inc.where(F.col("split") == "test"), pri)
    te = te.withColumn("_p", F.array(*[F.col("_m")[c] for c in classes]))
    return IO.wide_submission(te, "Id", "_p", classes)
