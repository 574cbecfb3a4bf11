"""Registered queries: agg."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...operators import agg as A
from ...operators.relate import with_row


@query("group_size", ["incidents"], "SELECT Address, Category, count(*) AS size FROM incidents GROUP BY Address, Category")
def group_size(spark, d):
    """AG1: rows per composite key."""
    return A.group_size(fx.incidents(spark, d), ["Address", "Category"])


@query("group_count_nonnull", ["bids"], "SELECT bidder_id, count(country) AS nctry FROM bids GROUP BY bidder_id")
def group_count_nonnull(spark, d):
    """AG2: NULL countries are not counted."""
    return A.group_agg(fx.bids(spark, d), ["bidder_id"], {"nctry": A.count_nonnull("country")})


@query("group_nunique", ["bids"], """
SELECT bidder_id, auction, count(DISTINCT device) AS dev, count(DISTINCT url) AS url,
       count(DISTINCT country) AS ctry FROM bids GROUP BY bidder_id, auction""")
def group_nunique(spark, d):
    """AG3: distinct non-null values of three columns, equal rows collapsed first."""
    return A.group_nunique(fx.bids(spark, d), ["bidder_id", "auction"], {"dev": "device", "url": "url", "ctry": "country"})


@query("group_nunique_merged", ["bids"], """
SELECT bidder_id, count(DISTINCT device) AS dev, count(DISTINCT url) AS url, count(DISTINCT country) AS ctry
FROM bids GROUP BY bidder_id""")
def group_nunique_merged(spark, d):
    """AG3: distinct counts per bidder from sketches of (bidder, auction, day), merged over days and then auctions.

    A bidder of these tables has few distinct values, which such a sketch counts without error."""
    cols = ["device", "url", "country"]
    daily = A.distinct_sketches(fx.bids(spark, d).withColumn("day", F.to_date("time")), ["bidder_id", "auction", "day"], cols)
    per = A.merge_sketches(A.merge_sketches(daily, ["bidder_id", "auction"], cols), ["bidder_id"], cols)
    return A.sketch_counts(per, {"dev": "device", "url": "url", "ctry": "country"})


@query("group_mean", ["bids"], "SELECT bidder_id, avg(country) AS avgctry FROM bids GROUP BY bidder_id")
def group_mean(spark, d):
    """AG4: mean ignoring NULL."""
    return A.group_agg(fx.bids(spark, d), ["bidder_id"], {"avgctry": F.avg("country")})


@query("group_max", ["bids"], "SELECT bidder_id, max(device) AS maxdev FROM bids GROUP BY bidder_id")
def group_max(spark, d):
    """AG5."""
    return A.group_agg(fx.bids(spark, d), ["bidder_id"], {"maxdev": F.max("device")})


@query("group_sum", ["passengers"], "SELECT Pclass, CAST(sum(Survived) AS BIGINT) AS survivors FROM passengers GROUP BY Pclass")
def group_sum(spark, d):
    """AG6."""
    return A.group_agg(fx.passengers(spark, d), ["Pclass"], {"survivors": F.sum("Survived")})


@query("group_median", None, """
SELECT l_returnflag, median(l_quantity) AS median FROM lineitem GROUP BY l_returnflag""")
def group_median(spark, d):
    """AG7: exact interpolating median per group over the fact table."""
    return A.group_median(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


@query("group_first", ["bids"], """
SELECT bidder_id, auction, first(country ORDER BY bid_id) AS firstctry,
       first(merchandise ORDER BY bid_id) AS mer FROM bids GROUP BY bidder_id, auction""")
def group_first(spark, d):
    """AG8: first row's value in bid order, NULL kept (A3)."""
    return A.group_agg(fx.bids(spark, d), ["bidder_id", "auction"],
                       {"firstctry": A.first_in_order("country", "bid_id"),
                        "mer": A.first_in_order("merchandise", "bid_id")})


@query("group_last_winner", ["bids"], """
SELECT auction, last(bidder_id ORDER BY bid_id) AS winner_id, count(DISTINCT bidder_id) AS nofbidders
FROM bids GROUP BY auction""")
def group_last_winner(spark, d):
    """AG9: the auction's last bidder in bid order."""
    return A.winners(fx.bids(spark, d), "auction", "bidder_id", "bid_id")


@query("two_level_agg", ["bids"], """
l AS (SELECT bidder_id, auction, count(bid_id) AS nb, count(DISTINCT device) AS dev
      FROM bids GROUP BY bidder_id, auction)
SELECT bidder_id, avg(nb) AS avgnofbids, avg(dev) AS nofdev, count(auction) AS nofauc
FROM l GROUP BY bidder_id""")
def two_level_agg(spark, d):
    """AG10: per (bidder, auction), then per bidder (a second, smaller shuffle on the bidder)."""
    return A.two_level_agg(fx.bids(spark, d), ["bidder_id"], ["auction"],
                           {"nb": F.count("bid_id"), "dev": A.nunique("device")},
                           {"avgnofbids": F.avg("nb"), "nofdev": F.avg("dev"), "nofauc": F.count("auction")})


_WIN = """w AS (SELECT auction, last(bidder_id ORDER BY bid_id) AS winner_id,
             count(DISTINCT bidder_id) AS nofbidders FROM bids GROUP BY auction)
"""


@query("agg_having_regroup", ["bids"], _WIN + """
SELECT winner_id AS bidder_id, count(*) AS nofwins2 FROM w WHERE nofbidders > 1 GROUP BY winner_id""")
def agg_having_regroup(spark, d):
    """AG11: wins in auctions with more than one bidder."""
    w = A.winners(fx.bids(spark, d), "auction", "bidder_id", "bid_id")
    return A.agg_having_regroup(w, F.col("nofbidders") > 1, "winner_id", "bidder_id", "nofwins2")


@query("wins_per_entity", ["bids"], _WIN + """
SELECT winner_id AS bidder_id, count(*) AS nofwins FROM w GROUP BY winner_id""")
def wins_per_entity(spark, d):
    """AG12."""
    w = A.winners(fx.bids(spark, d), "auction", "bidder_id", "bid_id")
    return A.wins_per_entity(w, "winner_id", "bidder_id", "nofwins")


@query("global_stats", ["passengers"], """
SELECT median(Fare) AS median_fare, max(Fare) AS max_fare, count(*) AS n FROM passengers""")
def global_stats(spark, d):
    """AG13: one-row frame of global median, max and row count."""
    p = fx.passengers(spark, d)
    med = A.global_median(p, "Fare", "median_fare")
    rest = A.global_stats(p, {"max_fare": F.max("Fare"), "n": F.count(F.lit(1))})
    return with_row(med, rest)  # two one-row frames side by side


@query("column_moments", ["digits"], """
e AS (SELECT CAST(unnest(px) AS DOUBLE) AS v, generate_subscripts(px, 1) AS i FROM digits)
SELECT CAST(i - 1 AS INTEGER) AS pos, avg(v) AS mean, stddev_samp(v) AS std FROM e GROUP BY i""")
def column_moments(spark, d):
    """AG14: element-wise mean and sample std of the pixel arrays, one row per pixel."""
    return A.array_moments(fx.digits(spark, d), "px")


@query("column_moments_wide", None, """
SELECT avg(l_quantity) AS l_quantity_mean, stddev_samp(l_quantity) AS l_quantity_std,
       avg(l_discount) AS l_discount_mean, stddev_samp(l_discount) AS l_discount_std,
       avg(l_tax) AS l_tax_mean, stddev_samp(l_tax) AS l_tax_std FROM lineitem""")
def column_moments_wide(spark, d):
    """AG14 wide form on named columns."""
    return A.column_moments(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


@query("value_counts", ["incidents"], "SELECT Category, count(*) AS count FROM incidents GROUP BY Category ORDER BY count DESC, Category")
def value_counts(spark, d):
    """AG15."""
    return A.value_counts(fx.incidents(spark, d), "Category")


@query("distinct_values", ["incidents"], "SELECT DISTINCT PdDistrict FROM incidents")
def distinct_values(spark, d):
    """AG16."""
    return A.distinct_values(fx.incidents(spark, d), "PdDistrict")


@query("group_mode_first_tie", ["incidents"], """
c AS (SELECT Address, Category, count(*) AS n, min(row_id) AS f FROM incidents GROUP BY Address, Category)
SELECT Address, Category AS mode FROM
  (SELECT *, row_number() OVER (PARTITION BY Address ORDER BY n DESC, f ASC) AS rn FROM c) x WHERE rn = 1""")
def group_mode_first_tie(spark, d):
    """AG17: most frequent category per address, ties to the one seen first."""
    return A.group_mode_first_tie(fx.incidents(spark, d), ["Address"], "Category", "row_id")
