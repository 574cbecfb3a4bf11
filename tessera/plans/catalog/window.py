"""Registered queries: window."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...operators import window as WN
from ...operators import ids as ID
from ...functions import scalar as S


def _passengers_keys(spark, d):
    p = fx.passengers(spark, d)
    return p.withColumns({"last": S.split_first("Name", ","),
                          "FamilySize": F.col("SibSp") + F.col("Parch"),
                          "_ord": F.struct(F.when(F.col("split") == "train", 0).otherwise(1).alias("s"),
                                           F.col("row_id").alias("r"))})


@query("lag_in_group", ["bids"], """
SELECT bid_id, bidder_id, auction, lag(time) OVER (PARTITION BY bidder_id, auction ORDER BY bid_id) AS timelag
FROM bids""")
def lag_in_group(spark, d):
    """WN1: previous bid time in the same (bidder, auction)."""
    b = fx.bids(spark, d).select("bid_id", "bidder_id", "auction", "time")
    return WN.lag_in_group(b, ["bidder_id", "auction"], "bid_id", "time", "timelag").drop("time")


@query("time_since_prev", ["bids"], """
SELECT bid_id, date_diff('microsecond', lag(time) OVER (PARTITION BY bidder_id, auction ORDER BY bid_id), time) AS timediff
FROM bids""")
def time_since_prev(spark, d):
    """WN2: microseconds since the previous bid in the group."""
    b = fx.bids(spark, d).select("bid_id", "bidder_id", "auction", "time")
    return WN.time_since_prev(b, ["bidder_id", "auction"], "bid_id", "time", "timediff").select("bid_id", "timediff")


@query("group_sum_broadcast", ["passengers"], """
SELECT row_id, split_part(Name, ',', 1) AS last,
       CAST(sum(CASE WHEN Sex = 'female' THEN 1 ELSE 0 END) OVER (PARTITION BY split_part(Name, ',', 1)) AS BIGINT) AS FamilyWomen
FROM passengers""")
def group_sum_broadcast(spark, d):
    """WN3: women per last name on every row."""
    p = fx.passengers(spark, d).select("row_id", S.split_first("Name", ",").alias("last"),
                                       (F.col("Sex") == "female").cast("int").alias("w"))
    return WN.group_sum_broadcast(p, "last", "w", "FamilyWomen").drop("w")


@query("leave_one_out_sum", ["passengers"], """
t AS (SELECT row_id, split_part(Name, ',', 1) AS last, coalesce(Survived, 0) AS s FROM passengers)
SELECT row_id, last, CAST(sum(s) OVER (PARTITION BY last) - s AS BIGINT) AS FamilySurvive FROM t""")
def leave_one_out_sum(spark, d):
    """WN4: survivors in the family other than the row itself."""
    p = fx.passengers(spark, d).select("row_id", S.split_first("Name", ",").alias("last"),
                                       F.coalesce("Survived", F.lit(0)).alias("s"))
    return WN.leave_one_out_sum(p, "last", "s", "FamilySurvive").drop("s")


@query("leave_one_out_sentinel", ["passengers"], """
t AS (SELECT row_id, coalesce(Cabin, 'UNK') AS Cabin, coalesce(Survived, 0) AS s FROM passengers)
SELECT row_id, Cabin,
       CASE WHEN Cabin = 'UNK' THEN 0 ELSE CAST(sum(s) OVER (PARTITION BY Cabin) - s AS BIGINT) END AS CabinSurvive
FROM t""")
def leave_one_out_sentinel(spark, d):
    """WN5: survivors in the cabin other than the row; the UNK sentinel (~75 % of rows) gets 0."""
    p = fx.passengers(spark, d).select("row_id", F.coalesce("Cabin", F.lit("UNK")).alias("Cabin"),
                                       F.coalesce("Survived", F.lit(0)).alias("s"))
    return WN.leave_one_out_sentinel(p, "Cabin", "s", "CabinSurvive", "UNK").drop("s")


@query("duplicate_flag", None, """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS INTEGER) AS IsDup FROM lineitem""")
def duplicate_flag(spark, d):
    """WN6: every member of a repeated (order, line number) is flagged."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return WN.duplicate_flag(li, ["l_orderkey", "l_linenumber"], "IsDup")


@query("same_place_count", None, """
SELECT l_orderkey, l_linenumber, count(l_quantity) OVER (PARTITION BY l_shipdate, l_quantity, l_discount) AS nofcrimes
FROM lineitem""")
def same_place_count(spark, d):
    """WN7: rows sharing (ship date, quantity, discount)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_discount")
    return (WN.same_place_count(li, ["l_shipdate", "l_quantity", "l_discount"], "nofcrimes", "l_quantity")
            .select("l_orderkey", "l_linenumber", "nofcrimes"))


_DENSE = """t AS (SELECT row_id, split_part(Name, ',', 1) AS last, SibSp + Parch AS FamilySize,
              row_number() OVER (ORDER BY CASE WHEN split = 'train' THEN 0 ELSE 1 END, row_id) AS ord
       FROM passengers),
f AS (SELECT last, FamilySize, min(ord) AS first FROM t GROUP BY last, FamilySize),
i AS (SELECT last, FamilySize, row_number() OVER (ORDER BY first) AS id FROM f)
"""


@query("dense_id_first_seen", ["passengers"], _DENSE + "SELECT row_id, last, FamilySize, id FROM t JOIN i USING (last, FamilySize)")
def dense_id_first_seen(spark, d):
    """WN8/SO5: family number in order of first appearance (train rows first)."""
    p = _passengers_keys(spark, d)
    return WN.dense_id_first_seen(p, ["last", "FamilySize"], "_ord", "id").select("row_id", "last", "FamilySize", "id")


@query("rare_group_collapse", ["passengers"], _DENSE + """
SELECT row_id, CASE WHEN FamilySize < 3 THEN -1 ELSE id END AS FamilyId FROM t JOIN i USING (last, FamilySize)""")
def rare_group_collapse(spark, d):
    """WN9: families below size 3 collapsed to -1."""
    p = dense_id_first_seen(spark, d)
    return p.select("row_id", WN.rare_group_collapse("id", "FamilySize", 3, -1).alias("FamilyId"))


@query("kfold_contiguous", ["bidders"], """
SELECT bidder_id, CAST(ntile(3) OVER (ORDER BY bidder_id) - 1 AS INTEGER) AS fold FROM bidders WHERE split = 'train'""")
def kfold_contiguous(spark, d):
    """WN10: three contiguous folds over the bidders in key order."""
    b = fx.bidders(spark, d).where(F.col("split") == "train").select("bidder_id")
    return ID.kfold_contiguous(b, ["bidder_id"], 3)


@query("kfold_stratified", ["bidders"], """
SELECT bidder_id, outcome,
       CAST(ntile(3) OVER (PARTITION BY outcome ORDER BY bidder_id) - 1 AS INTEGER) AS fold
FROM bidders WHERE split = 'train'""")
def kfold_stratified(spark, d):
    """WN11: three contiguous folds within each outcome class."""
    b = fx.bidders(spark, d).where(F.col("split") == "train").select("bidder_id", "outcome")
    return ID.kfold_stratified(b, "outcome", ["bidder_id"], 3)


@query("stratified_split")
def stratified_split(spark, d):
    """WN12: stratified shuffle split of the incidents by category (50 % train,
    10 % test per class, seeded). Rows-only: exact per-class counts are unit-tested."""
    i = fx.incidents(spark, d).where(F.col("split") == "train").select("row_id", "Category")
    return WN.stratified_split(i, "Category", "row_id", 0.5, 0.1, seed=1)


@query("stratified_split_counts", ["incidents"], """
n AS (SELECT Category, count(*) AS n FROM incidents WHERE split = 'train' GROUP BY Category),
c AS (SELECT Category, n, CAST(floor(n * 0.5 + 0.5) AS BIGINT) AS tr, CAST(floor(n * 0.1 + 0.5) AS BIGINT) AS te FROM n),
p AS (SELECT Category, 'train' AS part, tr AS n_rows FROM c UNION ALL SELECT Category, 'test', te FROM c
      UNION ALL SELECT Category, NULL, n - tr - te FROM c)
SELECT Category, part, n_rows FROM p WHERE n_rows > 0""")
def stratified_split_counts(spark, d):
    """WN12: rows of every class and part of the split (the draw itself is seeded, its counts are exact)."""
    return stratified_split(spark, d).groupBy("Category", "part").agg(F.count(F.lit(1)).alias("n_rows"))


@query("row_number_global", None, """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""")
def row_number_global(spark, d):
    """ID1: 1-based number over (order date, key) without a single-partition window."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ID.row_number_global(o, ["o_orderdate", "o_orderkey"], "rn").drop("o_orderdate")


@query("row_index_reset", ["incidents"], """
SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS index FROM incidents WHERE split = 'train'""")
def row_index_reset(spark, d):
    """ID2: 0..n-1 over the filtered rows."""
    i = fx.incidents(spark, d).where(F.col("split") == "train").select("row_id")
    return ID.row_index_reset(i, ["row_id"], "index")


@query("lag_in_group_skew_safe", ["bids"], """
SELECT bid_id, bidder_id, auction, lag(time) OVER (PARTITION BY bidder_id, auction ORDER BY bid_id) AS timelag
FROM bids""")
def lag_in_group_skew_safe(spark, d):
    """WN1, skew-safe form: self-join on the global row number in (bidder, auction, bid)."""
    b = fx.bids(spark, d).select("bid_id", "bidder_id", "auction", "time")
    return WN.lag_in_group(b, ["bidder_id", "auction"], "bid_id", "time", "timelag").drop("time")
