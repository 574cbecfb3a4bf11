"""Registered queries: composite feature tables and end-to-end flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ...sources.tables import table
from ..registry import query
from .. import bidders as BD
from .. import incidents as INC
from .. import passengers as PS
from .prep import _TITLE_CASE

_BIDDER_FEATURES_SQL = """
td AS (SELECT *, lag(time) OVER (PARTITION BY bidder_id, auction ORDER BY bid_id) AS timelag FROM bids),
td2 AS (SELECT *, date_diff('microsecond', timelag, time) AS timediff FROM td),
ent AS (SELECT bidder_id, outcome FROM bidders WHERE split = 'train'),
comb AS (SELECT b.bid_id, e.bidder_id, b.auction, b.device, b.url, b.country, b.timediff,
                b.merchandise, e.outcome
         FROM td2 b RIGHT JOIN ent e ON b.bidder_id = e.bidder_id),
agg1 AS (SELECT bidder_id, count(bid_id) AS nofbids, max(outcome) AS outcome FROM comb GROUP BY bidder_id),
lvl1 AS (SELECT bidder_id, auction, count(DISTINCT device) AS dev, count(DISTINCT url) AS url,
                count(DISTINCT country) AS ctry, count(bid_id) AS nb, avg(timediff) AS td,
                first(merchandise ORDER BY bid_id) AS mer
         FROM comb WHERE auction IS NOT NULL GROUP BY bidder_id, auction),
agg2 AS (SELECT bidder_id, avg(dev) AS nofdev, avg(url) AS nofurl, avg(ctry) AS nofctry,
                avg(nb) AS avgnofbids, avg(td) AS avgtimediff, count(mer) AS nofmer,
                count(auction) AS nofauc
         FROM lvl1 GROUP BY bidder_id),
agg3 AS (SELECT auction, last(bidder_id ORDER BY bid_id) AS winner_id,
                count(DISTINCT bidder_id) AS nofbidders
         FROM bids WHERE auction IS NOT NULL GROUP BY auction),
agg4 AS (SELECT winner_id AS bidder_id, count(nofbidders) AS nofwins FROM agg3
         WHERE winner_id IS NOT NULL GROUP BY winner_id),
agg5 AS (SELECT winner_id AS bidder_id, count(nofbidders) AS nofwins2 FROM agg3
         WHERE nofbidders > 1 AND winner_id IS NOT NULL GROUP BY winner_id),
mx AS (SELECT CAST(max(timediff) AS DOUBLE) AS m FROM td2)
SELECT a1.bidder_id, a1.nofbids, a1.outcome,
       coalesce(nofdev, 0) AS nofdev, coalesce(nofurl, 0) AS nofurl, coalesce(nofctry, 0) AS nofctry,
       coalesce(avgnofbids, 0) AS avgnofbids, coalesce(avgtimediff, mx.m) AS avgtimediff,
       coalesce(nofmer, 0) AS nofmer, coalesce(nofauc, 0) AS nofauc,
       coalesce(nofwins, 0) AS nofwins, coalesce(nofwins2, 0) AS nofwins2,
       coalesce(CAST(coalesce(nofwins, 0) AS DOUBLE) / nullif(coalesce(nofauc, 0), 0), 0) AS winpct
FROM agg1 a1 LEFT JOIN agg2 USING (bidder_id) LEFT JOIN agg4 USING (bidder_id)
     LEFT JOIN agg5 USING (bidder_id) CROSS JOIN mx
"""


@query("bidder_features", ["bids", "bidders"], _BIDDER_FEATURES_SQL)
def bidder_features(spark, sf_dir):
    """FE15 + the minimum slice (WN1, WN2, AG10, JN2, PR13, PR14)."""
    return BD.bidder_features(fx.bids(spark, sf_dir), fx.bidders(spark, sf_dir), "train")

_PASSENGER_FEATURES_SQL = f"""
b AS (SELECT row_id, PassengerId, split, Pclass, SibSp, Parch, Name,
             CAST(CASE WHEN Sex = 'male' THEN 0 WHEN Sex = 'female' THEN 1 END AS DOUBLE) AS Sex,
             CASE coalesce(Embarked, 'S') WHEN 'S' THEN 0 WHEN 'C' THEN 1 WHEN 'Q' THEN 2 END AS Embarked,
             Fare AS Fare0, Age AS Age0, SibSp + Parch AS FamilySize,
             CAST(length(Name) AS INTEGER) AS NameLength,
             regexp_extract(Name, ' ([A-Za-z]+)\\.', 1) AS tw, {_TITLE_CASE} AS Title,
             split_part(Name, ',', 1) AS last, coalesce(Cabin, 'UNK') AS Cabin,
             coalesce(Survived, 0) AS Survived,
             row_number() OVER (ORDER BY CASE WHEN split = 'train' THEN 0 ELSE 1 END, row_id) AS ord
      FROM passengers),
fm AS (SELECT median(Fare0) AS fm FROM b),
b2 AS (SELECT *, CASE WHEN Title = 0 THEN '?' || tw ELSE CAST(Title AS VARCHAR) END AS tg FROM b),
am AS (SELECT tg, median(Age0) AS am FROM b2 WHERE Age0 IS NOT NULL GROUP BY tg),
b3 AS (SELECT b2.*, coalesce(Fare0, fm.fm) AS Fare, coalesce(Age0, am.am) AS Age
       FROM b2 CROSS JOIN fm LEFT JOIN am USING (tg)),
b4 AS (SELECT *, CASE WHEN coalesce(Age < 18, false) THEN 1 ELSE 0 END AS child,
              CAST(Title IN (1, 3) AS INTEGER) AS Married FROM b3),
fam AS (SELECT last, FamilySize, min(ord) AS first, sum(Sex) AS FamilyWomen,
               CAST(sum(child) AS BIGINT) AS FamilyChildren, CAST(sum(Survived) AS BIGINT) AS fs
        FROM b4 GROUP BY last, FamilySize),
fid AS (SELECT *, row_number() OVER (ORDER BY first) AS id FROM fam),
cab AS (SELECT Cabin, CAST(sum(Survived) AS BIGINT) AS cs FROM b4 WHERE Cabin <> 'UNK' GROUP BY Cabin),
f AS (SELECT b4.*, fid.id, fid.FamilyWomen, fid.FamilyChildren,
             CASE WHEN b4.FamilySize < 3 THEN -1 ELSE fid.id END AS FamilyId,
             fid.fs - b4.Survived AS FamilySurvive,
             CASE WHEN b4.Cabin = 'UNK' THEN 0 ELSE cab.cs - b4.Survived END AS CabinSurvive,
             CASE regexp_extract(b4.Cabin, '^[A-Z]+', 0)
               WHEN 'UNK' THEN 1 WHEN 'C' THEN 2 WHEN 'B' THEN 3 WHEN 'D' THEN 4 WHEN 'E' THEN 5
               WHEN 'A' THEN 6 WHEN 'F' THEN 7 WHEN 'G' THEN 8 WHEN 'T' THEN 9 ELSE 0 END AS CabinLetter
      FROM b4 JOIN fid USING (last, FamilySize) LEFT JOIN cab USING (Cabin)),
pf AS (SELECT row_id, PassengerId, split, Survived, Name, Sex, Age, SibSp, Parch, Pclass, Fare, Cabin, Embarked,
              FamilySize, NameLength, Title, Married, child, id, FamilyWomen, FamilyChildren, FamilyId,
              FamilySurvive, CabinLetter, CabinSurvive,
              CASE WHEN coalesce((FamilySurvive > 0 OR CabinSurvive > 0) AND (Sex = 1 OR Age < 18), false)
                   THEN 1 ELSE 0 END AS helpdummy
       FROM f)
"""


@query("passenger_features", ["passengers"], _PASSENGER_FEATURES_SQL + "SELECT * FROM pf")
def passenger_features(spark, d):
    """FE16: the whole passenger feature table, train and test together."""
    return PS.passenger_features(fx.passengers(spark, d))


@query("help_indicator", ["passengers"], _PASSENGER_FEATURES_SQL +
       "SELECT row_id, FamilySurvive, CabinSurvive, helpdummy FROM pf")
def help_indicator(spark, d):
    """FE13: (family or cabin survivors) and (female or child)."""
    return PS.passenger_features(fx.passengers(spark, d)).select("row_id", "FamilySurvive", "CabinSurvive", "helpdummy")


_DAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]
_FEATS = (["X", "Y", "Time", "Minute", "Day", "Month", "Year", "nofcrimes", "IsInterection", "logoddsPA"]
          + [f"PD_D{i}" for i in range(10)] + [f"DAY_{x}" for x in _DAYS] + [f"logodds{k}" for k in range(5)])

_INCIDENT_FEATURES_SQL = """
tr0 AS (SELECT * FROM incidents WHERE split = 'train'),
xy AS (SELECT avg(X) AS mx, stddev_pop(X) AS sx, avg(Y) AS my, stddev_pop(Y) AS sy FROM tr0),
tr AS (SELECT * FROM (SELECT tr0.* REPLACE ((X - mx) / CASE WHEN sx = 0 THEN 1 ELSE sx END AS X,
                                            (Y - my) / CASE WHEN sy = 0 THEN 1 ELSE sy END AS Y)
                      FROM tr0, xy) z WHERE abs(Y) < 100),
n AS (SELECT count(*) AS N FROM tr),
a AS (SELECT Address, count(*) AS ac FROM tr GROUP BY Address),
pa AS (SELECT Address, CASE WHEN ac < N THEN ln(ac / N) - ln(1 - ac / N) END AS logoddsPA FROM a, n),
c AS (SELECT Category, count(*) AS cc FROM tr GROUP BY Category),
ci AS (SELECT Category, row_number() OVER (ORDER BY Category) - 1 AS k,
              CASE WHEN cc < N THEN ln(cc / N) - ln(1 - cc / N) END AS prior FROM c, n),
pc AS (SELECT Address, Category, count(*) AS pc FROM tr GROUP BY Address, Category),
grid AS (SELECT a.Address, ci.k,
                CASE WHEN pc.pc > 2 AND pc.pc < a.ac THEN ln(pc.pc / a.ac) - ln(1 - pc.pc / a.ac)
                     ELSE ci.prior END AS lo
         FROM a CROSS JOIN ci LEFT JOIN pc ON pc.Address = a.Address AND pc.Category = ci.Category),
lo AS (SELECT Address, """ + ", ".join(f"max(CASE WHEN k = {k} THEN lo END) AS logodds{k}" for k in range(5)) + """
       FROM grid GROUP BY Address),
f AS (SELECT row_id, X, Y, CAST(hour(Dates) AS INTEGER) AS Time, CAST(minute(Dates) AS INTEGER) AS Minute,
             CAST(day(Dates) AS INTEGER) AS Day, CAST(month(Dates) AS INTEGER) AS Month,
             CAST(year(Dates) AS INTEGER) AS Year,
             count(X) OVER (PARTITION BY Dates, X, Y) AS nofcrimes,
             CAST(contains(Address, '/') AS INTEGER) AS IsInterection, pa.logoddsPA, """ + ", ".join(
    [f"CAST(PdDistrict = 'D{i}' AS INTEGER) AS PD_D{i}" for i in range(10)]
    + [f"CAST(DayOfWeek = '{x}' AS INTEGER) AS DAY_{x}" for x in _DAYS]
    + [f"lo.logodds{k}" for k in range(5)]) + """
      FROM tr LEFT JOIN pa USING (Address) LEFT JOIN lo USING (Address))
SELECT f.*, CAST(count(*) OVER (PARTITION BY """ + ", ".join(_FEATS) + """) > 1 AS INTEGER) AS IsDup,
       CAST(Time = 0 OR Time BETWEEN 8 AND 23 AS INTEGER) AS Awake,
       CAST(Month IN (5, 6, 7) AS INTEGER) AS Summer, CAST(Month IN (8, 9, 10) AS INTEGER) AS Fall,
       CAST(Month IN (11, 0, 1) AS INTEGER) AS Winter, CAST(Month IN (2, 3, 4) AS INTEGER) AS Spring
FROM f
"""


@query("incident_features", ["incidents"], _INCIDENT_FEATURES_SQL)
def incident_features(spark, d):
    """FE14: the whole incident feature table of the train rows (unscaled)."""
    feats, _, _ = INC.train_features(fx.incidents(spark, d))
    return feats.drop("Category")


@query("stream_stateless_features", ["incidents"], """
tr AS (SELECT * FROM incidents WHERE split = 'train'),
n AS (SELECT count(*) AS N FROM tr),
pa AS (SELECT Address, CASE WHEN count(*) < max(N) THEN ln(count(*) / max(N)) - ln(1 - count(*) / max(N)) END AS logoddsPA
       FROM tr, n GROUP BY Address)
SELECT row_id, CAST(hour(Dates) AS INTEGER) AS Time, CAST(month(Dates) AS INTEGER) AS Month,
       CAST(hour(Dates) = 0 OR hour(Dates) BETWEEN 8 AND 23 AS INTEGER) AS Awake,
       CAST(contains(Address, '/') AS INTEGER) AS IsInterection, pa.logoddsPA
FROM incidents LEFT JOIN pa USING (Address)""")
def stream_stateless_features(spark, d):
    """§2.12: the events file read as a stream, turned into incident rows, given
    row-wise features and a stream-static lookup of the fitted address
    frequencies; written by a checkpointed file sink and read back."""
    from ...functions import scalar as S
    from ...operators import encode as E
    from ...streaming.stateless import run_available

    freq = E.fit_freq_log_odds(fx.incidents(spark, d).where(F.col("split") == "train"), "Address") \
        .select("Address", "logoddsPA")
    events_schema = table(spark, d, "events").schema

    def transform(ev):
        u = F.col("user_id")
        inc = ev.select(F.col("event_id").alias("row_id"), F.col("ts").alias("Dates"),
                        F.concat(u.cast("string"), F.when(u % 3 == 0, F.lit(" A / B"))
                                 .otherwise(F.lit(" BLOCK"))).alias("Address"))
        return (inc.join(freq, "Address", "left")
                .select("row_id", F.hour("Dates").alias("Time"), F.month("Dates").alias("Month"),
                        S.hour_band_flag(F.hour("Dates")).alias("Awake"),
                        S.contains_flag("Address", "/").alias("IsInterection"), "logoddsPA"))

    out = run_available(spark, f"{d}/events.parquet", events_schema, transform, "features")
    return spark.read.parquet(out)
