"""Bidder flow: bid log + bidder table -> feature table -> models -> submission.

Plan shape (FE15):
  bids --lag (sorted range partitions, so a hot (bidder, auction) is
  spread)--> per (bidder, auction) partial aggregate
  --> per bidder aggregate.
  bids --shuffle on auction--> winner per auction --> wins per winner.
  bidders(split) left-join both per-bidder tables (all keyed on bidder_id).
The per-bidder tables are computed once from all bids and shared by the
train and test feature tables, rather than copied per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import agg as A
from ..operators import window as WN
from ..operators.relate import with_row

# fixed values: predictor names of the reference bidder model
PREDICTORS = ["nofdev", "nofurl", "avgnofbids", "avgtimediff", "nofmer", "nofauc", "nofwins"]

# fixed values: the feature table's columns, in order
FEATURE_COLUMNS = ["bidder_id", "nofbids", "outcome", "nofdev", "nofurl", "nofctry", "avgnofbids",
                   "avgtimediff", "nofmer", "nofauc", "nofwins", "nofwins2", "winpct"]


def bids_with_timediff(bids: DataFrame) -> DataFrame:
    """WN1+WN2: previous bid time in (bidder, auction) and the difference (us).

    Rows with a NULL bidder or auction belong to no group (pandas drops NULL
    keys), so their lag is NULL. One (bidder, auction) may hold a large share
    of the bids (a bot); the lag works on range partitions, which split it.
    """
    d = WN.time_since_prev(bids, ["bidder_id", "auction"], "bid_id", "time", "timediff", "timelag")
    keyed = F.col("bidder_id").isNotNull() & F.col("auction").isNotNull()
    return d.withColumns({"timelag": F.when(keyed, F.col("timelag")),
                          "timediff": F.when(keyed, F.col("timediff"))})


def per_bidder_auction_features(bids_td: DataFrame) -> DataFrame:
    """AG10: per (bidder, auction) then per bidder. ``nofbids`` counts every bid,
    including those whose auction is NULL (they form no auction group, A1)."""
    # equal (device, url, country) bids collapse first, so that the three distinct
    # counts expand these few rows and not every bid
    first = F.struct("bid_id", "merchandise")
    few = (bids_td.where(F.col("bidder_id").isNotNull())
           .groupBy("bidder_id", "auction", "device", "url", "country")
           .agg(F.count("bid_id").alias("nb"), F.sum("timediff").alias("td"), F.count("timediff").alias("ntd"),
                F.max("timediff").alias("mtd"), F.min(first).alias("first")))
    lvl1 = (few.groupBy("bidder_id", "auction")
            .agg(F.count_distinct("device").alias("dev"),
                 F.count_distinct("url").alias("url"),
                 F.count_distinct("country").alias("ctry"),
                 F.sum("nb").alias("nb"),
                 F.try_divide(F.sum("td"), F.sum("ntd")).alias("td"),
                 F.max("mtd").alias("mtd"),
                 F.min("first").alias("first"))
            .withColumn("mer", F.col("first.merchandise")))
    has_auc = F.col("auction").isNotNull()
    return lvl1.groupBy("bidder_id").agg(
        F.sum("nb").alias("nofbids"),
        F.avg(F.when(has_auc, F.col("dev"))).alias("nofdev"),
        F.avg(F.when(has_auc, F.col("url"))).alias("nofurl"),
        F.avg(F.when(has_auc, F.col("ctry"))).alias("nofctry"),
        F.avg(F.when(has_auc, F.col("nb"))).alias("avgnofbids"),
        F.avg(F.when(has_auc, F.col("td"))).alias("avgtimediff"),
        F.count(F.when(has_auc, F.col("mer"))).alias("nofmer"),
        F.count("auction").alias("nofauc"),
        F.max("mtd").alias("_maxtd_b"))


def auction_winners(bids: DataFrame) -> DataFrame:
    """AG9 + AG3: last bidder in bid order and distinct bidders per auction."""
    return A.winners(bids, "auction", "bidder_id", "bid_id", "winner_id", "nofbidders")


def wins(bids: DataFrame) -> DataFrame:
    """AG12 + AG11: wins, and wins in auctions with more than one bidder, per bidder."""
    return A.wins_per_entity(auction_winners(bids), "winner_id", "bidder_id", "nofwins",
                             contested_col="nofbidders", min_entities=2, contested_out="nofwins2")


def bidder_features(bids: DataFrame, bidders: DataFrame, split: str | None = "train",
                    with_outcome: bool = True) -> DataFrame:
    """FE15: one row per bidder of the split (all bidders if ``split`` is None)."""
    td = bids_with_timediff(bids)
    per_bidder = per_bidder_auction_features(td)
    # largest time difference over all bids, taken from the per-bidder maxima
    # (one row; no second pass over the bids)
    max_td = per_bidder.agg(F.max("_maxtd_b").cast("double").alias("_maxtd"))
    ent = bidders if split is None else bidders.where(F.col("split") == split)
    cols = (["bidder_id"] + (["outcome"] if with_outcome else [])
            + (["split"] if split is None and "split" in bidders.columns else []))
    res = (ent.select(*cols)
           .join(per_bidder, "bidder_id", "left")
           .join(wins(bids), "bidder_id", "left"))
    res = with_row(res, max_td)
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in
            ["nofbids", "nofdev", "nofurl", "nofctry", "nofauc", "nofwins", "nofwins2", "nofmer", "avgnofbids"]}
    res = (res.withColumns(zero)
           .withColumn("avgtimediff", F.coalesce(F.col("avgtimediff"), F.col("_maxtd")))
           .withColumn("winpct", F.coalesce(F.try_divide(F.col("nofwins"), F.col("nofauc")), F.lit(0.0)))
           .withColumns({c: F.col(c).cast("double") for c in ["nofdev", "nofurl", "nofctry", "avgnofbids"]})
           .drop("_maxtd", "_maxtd_b"))
    keep = FEATURE_COLUMNS + (["split"] if "split" in cols else [])
    return res.select(*[c for c in keep if c in res.columns])


def _flow(bids: DataFrame, bidders: DataFrame, num_trees: int, max_depth: int, lr_iter: int):
    """Train and test rows with the predictor vector, and the two fits.

    One feature table for all bidders, split by tag afterwards; folds follow
    bidder_id order (the reference's aggregate output order).
    """
    from ..operators import model as M

    feats = M.assemble(bidder_features(bids, bidders, None).withColumn("label", F.col("outcome")),
                       PREDICTORS).checkpoint()

    def rf(d):
        return M.random_forest("label", "features", num_trees, 2, max_depth, key=["bidder_id"]).fit(d)

    def lr(d):
        return M.logistic(d.count(), "label", "features", lr_iter).fit(d)  # C = 1: one over the rows fitted on

    return feats.where(F.col("split") == "train"), feats.where(F.col("split") == "test"), rf, lr


def flow_scores(bids: DataFrame, bidders: DataFrame, num_trees: int = 150, max_depth: int = 30,
                lr_iter: int = 100, k: int = 3) -> DataFrame:
    """ML17 scores: (score, fold, accuracy): cross-validation of the forest and of the
    logistic regression, and the out-of-fold OR vote (fold -1)."""
    from ..functions.scalar import vote_or
    from ..operators import ids as ID
    from ..operators import model as M
    from ..operators.metric import accuracy

    train, _, rf, lr = _flow(bids, bidders, num_trees, max_depth, lr_iter)
    strat = ID.kfold_stratified(train, "label", ["bidder_id"], k, "fold").checkpoint()
    cv = [M.cv_accuracy(strat, "fold", k, m, "label").select(F.lit(n).alias("score"), "fold", "accuracy")
          for n, m in (("cv_forest", rf), ("cv_logistic", lr))]
    contig = ID.kfold_contiguous(train, ["bidder_id"], k, "fold")
    oof = M.oof_scores(contig, "bidder_id", "fold", k, [("rf", rf), ("lr", lr)])
    wide = oof.groupBy("bidder_id").pivot("model", ["rf", "lr"]).agg(F.first("score"))
    vote = wide.select("bidder_id", vote_or("rf", "lr").cast("double").alias("prediction"))
    acc = accuracy(vote.join(train.select("bidder_id", "label"), "bidder_id"))
    return cv[0].unionByName(cv[1]).unionByName(
        acc.select(F.lit("oof_or_vote").alias("score"), F.lit(-1).alias("fold"), "accuracy"))


def run_flow(bids: DataFrame, bidders: DataFrame, num_trees: int = 150, max_depth: int = 30,
             lr_iter: int = 100) -> DataFrame:
    """ML17: the submission (bidder_id, predictions) of the forest fitted on all training rows."""
    train, test, rf, _ = _flow(bids, bidders, num_trees, max_depth, lr_iter)
    return rf(train).transform(test).select("bidder_id", F.col("prediction").cast("int").alias("predictions"))
