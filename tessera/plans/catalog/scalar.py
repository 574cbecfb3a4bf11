"""Registered queries: scalar."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...functions import scalar as S


@query("str_length", ["passengers"], "SELECT row_id, CAST(length(Name) AS INTEGER) AS NameLength FROM passengers")
def str_length(spark, d):
    """SC1."""
    return fx.passengers(spark, d).select("row_id", S.str_length("Name").alias("NameLength"))


@query("str_length_documents", None, "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def str_length_documents(spark, d):
    """SC1 over whole document texts."""
    return table(spark, d, "documents").select("doc_id", S.str_length("text").alias("n"))


@query("regex_group", ["passengers"], "SELECT row_id, regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) AS TitleWord FROM passengers")
def regex_group(spark, d):
    """SC2: title word, '' if absent."""
    return fx.passengers(spark, d).select("row_id", S.regex_group("Name").alias("TitleWord"))


@query("regex_prefix", ["passengers"], "SELECT row_id, regexp_extract(coalesce(Cabin, 'UNK'), '^[A-Z]+', 0) AS Deck FROM passengers")
def regex_prefix(spark, d):
    """SC3: leading capitals of the cabin."""
    return fx.passengers(spark, d).select("row_id", S.regex_prefix(F.coalesce("Cabin", F.lit("UNK"))).alias("Deck"))


@query("split_first", ["passengers"], "SELECT row_id, split_part(Name, ',', 1) AS last FROM passengers")
def split_first(spark, d):
    """SC4: last name before the comma."""
    return fx.passengers(spark, d).select("row_id", S.split_first("Name", ",").alias("last"))


@query("concat_key", ["passengers"], """
SELECT row_id, concat(split_part(Name, ',', 1), CAST(SibSp + Parch AS VARCHAR)) AS family_key FROM passengers""")
def concat_key(spark, d):
    """SC5: text key of last name and family size."""
    p = fx.passengers(spark, d)
    return p.select("row_id", S.concat_key(S.split_first("Name", ","), F.col("SibSp") + F.col("Parch")).alias("family_key"))


@query("contains_flag", ["incidents"], "SELECT row_id, CAST(contains(Address, '/') AS INTEGER) AS IsInterection FROM incidents")
def contains_flag(spark, d):
    """SC6: intersection marker."""
    return fx.incidents(spark, d).select("row_id", S.contains_flag("Address", "/").alias("IsInterection"))


@query("parse_timestamp", None, """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS txt,
       strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM orders""")
def parse_timestamp(spark, d):
    """SC7: timestamp text parsed back by pattern."""
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("txt"))
    return o.withColumn("parsed", S.parse_timestamp("txt"))


@query("date_parts", ["incidents"], """
SELECT row_id, CAST(hour(Dates) AS INTEGER) AS Time, CAST(minute(Dates) AS INTEGER) AS Minute,
       CAST(day(Dates) AS INTEGER) AS Day, CAST(month(Dates) AS INTEGER) AS Month,
       CAST(year(Dates) AS INTEGER) AS Year FROM incidents""")
def date_parts(spark, d):
    """SC8."""
    i = fx.incidents(spark, d)
    return i.select("row_id", *[c.alias(n) for n, c in S.date_parts("Dates").items()])


@query("hour_band_flag", ["incidents"], """
SELECT row_id, CAST(hour(Dates) = 0 OR hour(Dates) BETWEEN 8 AND 23 AS INTEGER) AS Awake FROM incidents""")
def hour_band_flag(spark, d):
    """SC9."""
    return fx.incidents(spark, d).select("row_id", S.hour_band_flag(F.hour("Dates")).alias("Awake"))


@query("log_odds", ["votes"], """
SELECT row_id, CASE WHEN s1 > 0 AND s1 < 1 THEN ln(s1) - ln(1 - s1) END AS lo FROM votes""")
def log_odds(spark, d):
    """SC11: NULL at 0 and 1 (A4)."""
    return fx.votes(spark, d).select("row_id", S.log_odds("s1").alias("lo"))


@query("neg_log10", ["votes"], "SELECT row_id, CASE WHEN s1 > 0 THEN -log10(s1) END AS score FROM votes")
def neg_log10(spark, d):
    """SC12."""
    return fx.votes(spark, d).select("row_id", S.neg_log10("s1").alias("score"))
