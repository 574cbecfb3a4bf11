"""Registered queries: relate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from ...operators import relate as R
from .. import bidders as BD


def _train_bidders(spark, d):
    return fx.bidders(spark, d).where(F.col("split") == "train")


def _addresses(spark, d, split):
    return fx.incidents(spark, d).where(F.col("split") == split).select("Address")


@query("join_right", ["bids", "bidders"], """
SELECT b.bid_id, e.bidder_id, e.outcome
FROM bids b RIGHT JOIN (SELECT * FROM bidders WHERE split = 'train') e ON b.bidder_id = e.bidder_id""")
def join_right(spark, d):
    """JN1: every train bidder kept; bidders without bids get NULL bid_id."""
    return R.join_right(fx.bids(spark, d).select("bid_id", "bidder_id"),
                        _train_bidders(spark, d).select("bidder_id", "outcome"), "bidder_id")


_CHAIN = """
n AS (SELECT bidder_id, count(bid_id) AS nofbids FROM bids GROUP BY bidder_id),
w AS (SELECT winner_id AS bidder_id, count(*) AS nofwins FROM
        (SELECT auction, last(bidder_id ORDER BY bid_id) AS winner_id FROM bids GROUP BY auction) x
      GROUP BY winner_id),
m AS (SELECT bidder_id, max(device) AS maxdev FROM bids GROUP BY bidder_id)
SELECT e.bidder_id, n.nofbids, w.nofwins, m.maxdev
FROM (SELECT bidder_id FROM bidders WHERE split = 'train') e
  LEFT JOIN n USING (bidder_id) LEFT JOIN w USING (bidder_id) LEFT JOIN m USING (bidder_id)"""


def _chain(spark, d):
    b = fx.bids(spark, d)
    n = b.groupBy("bidder_id").agg(F.count("bid_id").alias("nofbids"))
    w = BD.wins(b).select("bidder_id", "nofwins")
    m = b.groupBy("bidder_id").agg(F.max("device").alias("maxdev"))
    return _train_bidders(spark, d).select("bidder_id"), [n, w, m]


@query("join_left_chain", ["bids", "bidders"], _CHAIN)
def join_left_chain(spark, d):
    """JN2: three per-bidder tables left-joined on one key."""
    return R.join_left_chain(*_chain(spark, d), "bidder_id")


@query("join_left_stored", ["bids", "bidders"], _CHAIN)
def join_left_stored(spark, d):
    """JN2 over stored layouts: the same tables written bucketed by the key, joined without an exchange."""
    base, others = _chain(spark, d)
    return R.join_left_stored(base, others, "bidder_id", int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("agg_join_back", None, """
SELECT l_orderkey, l_linenumber, l_partkey,
       count(l_quantity) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
FROM lineitem""")
def agg_join_back(spark, d):
    """JN3: count per (order, line number) on every line (the key repeats)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return R.count_join_back(li, ["l_orderkey", "l_linenumber"], "n", "l_quantity").drop("l_quantity")


@query("lookup_join", ["bids"], """
t AS (SELECT auction, count(DISTINCT bidder_id) AS nofbidders FROM bids GROUP BY auction)
SELECT bid_id, auction, nofbidders FROM bids LEFT JOIN t USING (auction)""")
def lookup_join(spark, d):
    """JN4: learned per-auction value looked up on every bid."""
    b = fx.bids(spark, d)
    t = b.groupBy("auction").agg(F.count_distinct("bidder_id").alias("nofbidders"))
    return R.lookup_join(b.select("bid_id", "auction"), t, "auction")


@query("align_by_row_id", ["passengers"], "SELECT row_id, Name, CAST(length(Name) AS INTEGER) AS NameLength FROM passengers")
def align_by_row_id(spark, d):
    """JN5: two frames of the same rows aligned by the explicit row id."""
    p = fx.passengers(spark, d)
    right = p.select("row_id", F.length("Name").alias("NameLength"))
    return R.align_by_row_id(p.select("row_id", "Name"), right)


_SETS = """tr AS (SELECT Address FROM incidents WHERE split = 'train'),
te AS (SELECT Address FROM incidents WHERE split = 'test')
"""


@query("keys_only_new", ["incidents"], _SETS + "SELECT DISTINCT Address FROM te WHERE Address NOT IN (SELECT Address FROM tr)")
def keys_only_new(spark, d):
    """JN6: test addresses never seen in train (anti join)."""
    return R.keys_only_new(_addresses(spark, d, "test"), _addresses(spark, d, "train"), "Address")


@query("keys_only_old", ["incidents"], _SETS + "SELECT DISTINCT Address FROM tr WHERE Address NOT IN (SELECT Address FROM te)")
def keys_only_old(spark, d):
    """JN7: train addresses absent from test."""
    return R.keys_only_old(_addresses(spark, d, "test"), _addresses(spark, d, "train"), "Address")


@query("keys_in_both", ["incidents"], _SETS + "SELECT DISTINCT Address FROM te WHERE Address IN (SELECT Address FROM tr)")
def keys_in_both(spark, d):
    """JN8: addresses in both (semi join)."""
    return R.keys_in_both(_addresses(spark, d, "test"), _addresses(spark, d, "train"), "Address")


@query("union_tagged", ["passengers"], """
SELECT row_id, Name, Survived, 'train' AS split FROM passengers WHERE split = 'train'
UNION ALL
SELECT row_id, Name, CAST(NULL AS INTEGER) AS Survived, 'test' AS split FROM passengers WHERE split = 'test'""")
def union_tagged(spark, d):
    """ST1: train (with Survived) over test (without): missing column -> NULL."""
    p = fx.passengers(spark, d)
    tr = p.where(F.col("split") == "train").select("row_id", "Name", "Survived")
    te = p.where(F.col("split") == "test").select("row_id", "Name")
    return R.union_tagged([("train", tr), ("test", te)], "split")


@query("split_by_tag", ["passengers"], "SELECT row_id, Name, CAST(NULL AS INTEGER) AS Survived, split FROM passengers WHERE split = 'test'")
def split_by_tag(spark, d):
    """ST2: the test part of the tagged union."""
    return R.split_by_tag(union_tagged(spark, d), "test")


@query("set_union", ["incidents"], _SETS + "SELECT Address FROM tr UNION SELECT Address FROM te")
def set_union(spark, d):
    """ST3."""
    return R.set_union(_addresses(spark, d, "train"), _addresses(spark, d, "test"))


@query("set_difference", ["incidents"], _SETS + "SELECT Address FROM te EXCEPT SELECT Address FROM tr")
def set_difference(spark, d):
    """ST4."""
    return R.set_difference(_addresses(spark, d, "test"), _addresses(spark, d, "train"))


@query("set_intersection", ["incidents"], _SETS + "SELECT Address FROM te INTERSECT SELECT Address FROM tr")
def set_intersection(spark, d):
    """ST5."""
    return R.set_intersection(_addresses(spark, d, "test"), _addresses(spark, d, "train"))


@query("sorted_distinct", ["incidents"], "SELECT DISTINCT Category FROM incidents ORDER BY Category")
def sorted_distinct(spark, d):
    """SO1."""
    return R.sorted_distinct(fx.incidents(spark, d), "Category")


@query("agg_sorted", ["bids"], "SELECT bidder_id, count(*) AS n FROM bids GROUP BY bidder_id ORDER BY bidder_id")
def agg_sorted(spark, d):
    """SO2: aggregate in key order."""
    a = fx.bids(spark, d).groupBy("bidder_id").agg(F.count(F.lit(1)).alias("n"))
    return R.agg_sorted(a, "bidder_id")


@query("head_rows", ["incidents"], "SELECT row_id, Category, Address FROM incidents ORDER BY row_id LIMIT 5")
def head_rows(spark, d):
    """SO3: first five rows in row order."""
    return R.head_rows(fx.incidents(spark, d).select("row_id", "Category", "Address"), ["row_id"], 5)
