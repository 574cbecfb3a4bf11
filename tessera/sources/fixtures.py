"""Fixture views: the contest table shapes built over the given tables.

Each view is a plain projection of one given table (no shuffle), so the work
grows with the table. The DuckDB text of the same views lives in
``tessera.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid log: bid_id (unique order column), bidder_id, auction, merchandise,
    time (timestamp), device, url, country (NULL for some rows)."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return (ev.withColumn("k", k)
            .select(F.col("event_id").alias("bid_id"),
                    F.col("user_id").alias("bidder_id"),
                    F.concat("event_type", F.lit("-"),
                             (F.dayofmonth("ts") % 5).cast("string")).alias("auction"),
                    F.col("event_type").alias("merchandise"),
                    F.col("ts").alias("time"),
                    F.col("k").alias("device"),
                    (F.col("k") % 13).alias("url"),
                    F.when(F.col("k") % 11 == 0, F.lit(None))
                     .otherwise(F.col("k") % 7).alias("country")))


def bidders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity table: bidder_id, outcome (0/1 double), split ('train'/'test')."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("bidder_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(1.0)).otherwise(F.lit(0.0)).alias("outcome"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"))


# fixed values: title words used to build names in the passengers view
_TITLE_WORDS = ["Mr", "Miss", "Mrs", "Master", "Col", "Zed", "Ms"]


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passenger table, train and test tagged in ``split``; order column row_id."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    title = F.element_at(F.array(*[F.lit(t) for t in _TITLE_WORDS]), (k % 7 + 1).cast("int"))
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    deck = (F.when(F.col("p_size") % 3 == 0, F.lit("A"))
            .when(F.col("p_size") % 3 == 1, F.lit("C")).otherwise(F.lit("F G")))
    return p.select(
        k.alias("row_id"), k.alias("PassengerId"),
        F.when(k % 4 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.when(k % 4 == 0, F.lit(None).cast("int"))
         .when(F.col("p_type").isin("PROMO", "SMALL"), F.lit(1)).otherwise(F.lit(0)).alias("Survived"),
        F.concat(first, F.lit(", "), title, F.lit(". "), second).alias("Name"),
        F.when(k % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("Sex"),
        F.when((k % 5 == 0) | (k % 7 == 5), F.lit(None).cast("double"))
         .otherwise(F.col("p_size").cast("double")).alias("Age"),
        (k % 3).cast("int").alias("SibSp"), (k % 4).cast("int").alias("Parch"),
        (k % 3 + 1).cast("int").alias("Pclass"),
        F.when(k % 50 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("Fare"),
        F.when(k % 4 != 1, F.lit(None).cast("string"))
         .otherwise(F.concat(deck, F.col("p_size").cast("string"))).alias("Cabin"),
        F.when(k % 90 == 1, F.lit(None).cast("string")).when(k % 3 == 0, F.lit("S"))
         .when(k % 3 == 1, F.lit("C")).otherwise(F.lit("Q")).alias("Embarked"))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident log, train and test tagged in ``split``; order column row_id."""
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    return e.select(
        F.col("event_id").alias("row_id"), F.col("event_id").alias("Id"),
        F.col("ts").alias("Dates"), F.col("event_type").alias("Category"),
        F.when((u % 7 == 0) | (F.col("event_id") % 5 == 0), F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.concat(u.cast("string"), F.when(u % 3 == 0, F.lit(" A / B")).otherwise(F.lit(" BLOCK"))).alias("Address"),
        F.concat(F.lit("D"), (u % 10).cast("string")).alias("PdDistrict"),
        F.date_format("ts", "EEEE").alias("DayOfWeek"),
        F.col("value").alias("X"), (F.col("event_id") % 97).cast("double").alias("Y"))


def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image table: row_id, label, px (array<float>, row-major), width."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), "label",
                    F.col("embedding").alias("px"), F.lit(8).alias("width"))


def vote_columns(row_id: Column, label: Column, n_models: int = 5) -> list[Column]:
    """Deterministic integer predictions p0..p{n-1} per row (fixture for votes)."""
    return [((row_id * (m + 2) + label * m) % 4).cast("int").alias(f"p{m}") for m in range(n_models)]


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row: label, five model predictions p0..p4 and two scores s1, s2 in [0, 1]."""
    d = digits(spark, sf_dir)
    r = F.col("row_id")
    return d.select("row_id", "label", *vote_columns(r, F.col("label")),
                    ((r * 37) % 101 / F.lit(100.0)).alias("s1"),
                    ((r * 53) % 101 / F.lit(100.0)).alias("s2"))
