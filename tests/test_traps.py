"""Hand-written rows for the semantic traps (SURVEY Appendix A) and FIXTURES §4."""

import math

from pyspark.sql import functions as F

from tessera.functions import arrays as AR
from tessera.functions import scalar as S
from tessera.operators import agg as A
from tessera.operators import encode as E
from tessera.operators import ids as ID
from tessera.operators import prep as P
from tessera.operators import window as WN
from tessera.plans import bidders as BD
from tessera.plans import passengers as PS


def _bids(spark, rows):
    return spark.createDataFrame(rows, "bid_id long, bidder_id long, auction string, merchandise string, "
                                       "time timestamp_ntz, device int, url int, country int")


def test_bidder_without_bids_and_null_country(spark):
    import datetime as dt
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    bids = _bids(spark, [(1, 10, "a1", "m", t(0), 1, 1, None), (2, 10, "a1", "m", t(5), 2, 1, 3),
                         (3, 11, "a2", "m", t(7), 1, 2, 4), (4, 10, "a2", None, t(9), 1, 2, None)])
    bidders = spark.createDataFrame([(10, 1.0, "train"), (11, 0.0, "train"), (12, 0.0, "train")],
                                    "bidder_id long, outcome double, split string")
    f = {r.bidder_id: r for r in BD.bidder_features(bids, bidders, "train").collect()}
    assert f[12].nofbids == 0 and f[12].nofauc == 0 and f[12].nofwins == 0 and f[12].winpct == 0.0
    assert f[12].avgtimediff == 5_000_000.0  # max difference over all bids (A1 fill)
    assert f[10].nofauc == 2 and f[10].nofwins == 2  # last bidder of a1 and of a2
    assert f[10].nofwins2 == 1  # a2 had two bidders
    assert f[10].nofctry == 0.5  # a1: 1 distinct non-null, a2: 0
    assert f[10].nofmer == 1  # a2's first bid has no merchandise
    assert f[11].nofwins == 0


def test_first_value_keeps_null(spark):
    df = spark.createDataFrame([(1, "k", None), (2, "k", 5)], "o long, k string, v int")
    r = A.group_agg(df, ["k"], {"f": A.first_in_order("v", "o"), "l": A.last_in_order("v", "o")}).first()
    assert r.f is None and r.l == 5


def test_null_keys_dropped_by_groupby(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert [r.k for r in A.group_size(df, ["k"]).collect()] == ["a"]


def test_division_and_log_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.5, 2.0)], "a double, b double")
    r = df.select(P.ratio("a", "b").alias("r"), S.log_odds("a").alias("lo"), S.neg_log10("a").alias("nl")).collect()
    assert r[0].r is None and r[1].r is None and r[2].r == 0.25
    assert r[0].lo is None and r[1].lo is None and abs(r[2].lo) < 1e-12
    assert r[1].nl is None


def test_null_mask_keeps_value(spark):
    df = spark.createDataFrame([(None,), (17.0,), (18.0,)], "Age double").withColumn("child", F.lit(0))
    out = [r.child for r in P.conditional_update(df, "child", F.col("Age") < 18, 1).collect()]
    assert out == [0, 1, 0]  # NULL -> unchanged, 18 is not a child


def test_unmatched_recode_is_zero(spark):
    df = spark.createDataFrame([("Smith, Mr. John",), ("Doe, Zed. Jane",), ("no title",), ("x, mr. lower",)], "Name string")
    assert [r.t for r in df.select(PS.title_code("Name").alias("t")).collect()] == [1, 0, 0, 0]
    cab = spark.createDataFrame([("F G73",), ("UNK",), ("c12",), ("T1",)], "Cabin string")
    assert [r.d for r in cab.select(PS.deck_code("Cabin").alias("d")).collect()] == [7, 1, 0, 9]


def test_seasons_and_hours(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    rows = df.select("m", *[c.alias(n) for n, c in S.season_flags("m").items()]).orderBy("m").collect()
    assert sum(r.Summer + r.Fall + r.Winter + r.Spring for r in rows if r.m == 12) == 0  # A8
    assert rows[0].Winter == 1 and rows[4].Summer == 1 and rows[7].Fall == 1 and rows[1].Spring == 1
    h = spark.createDataFrame([(0,), (1,), (7,), (8,), (23,)], "h int")
    assert [r.a for r in h.select(S.hour_band_flag("h").alias("a")).collect()] == [1, 0, 0, 1, 1]


def test_log_odds_guard_counts(spark):
    rows = ([("k1", "A")] * 2 + [("k1", "B")] * 3 + [("k2", "A")] * 3 + [("k3", "A")] * 4 + [("k3", "B")] * 4)
    df = spark.createDataFrame(rows, "key string, c string")
    lo, prior = E.fit_target_log_odds(df, "key", "c", 2)
    t = {r.key: r.logodds for r in lo.collect()}
    pr = prior.first()._prior
    n = len(rows)
    assert math.isclose(pr[0], math.log(9 / n) - math.log(1 - 9 / n))
    assert t["k1"][0] == pr[0]  # count 2 is not above the guard
    assert math.isclose(t["k1"][1], math.log(3 / 5) - math.log(2 / 5))  # count 3 kept
    assert t["k2"][0] == pr[0]  # all rows in one category: not below the key total
    assert math.isclose(t["k3"][0], 0.0, abs_tol=1e-12)


def test_families_of_two_and_three(spark):
    df = spark.createDataFrame([(1, 2, 7), (2, 3, 7)], "row_id long, FamilySize int, id long")
    out = [r.f for r in df.select(WN.rare_group_collapse("id", "FamilySize").alias("f")).orderBy("row_id").collect()]
    assert out == [-1, 7]


def test_folds_for_7_8_9(spark):
    for n, sizes in ((7, [3, 2, 2]), (8, [3, 3, 2]), (9, [3, 3, 3])):
        df = spark.range(n).withColumnRenamed("id", "r")
        got = ID.kfold_contiguous(df, ["r"], 3).orderBy("r").collect()
        folds = [x.fold for x in got]
        assert [folds.count(k) for k in range(3)] == sizes
        assert folds == sorted(folds)  # contiguous


def test_plurality_ties(spark):
    df = spark.createDataFrame([([1, 2, 1, 2, 3],), ([4, 5, 6, 7, 8],), ([2, 3, 3, 2, 9],), ([5, 5, 1, 1, 1],)], "v array<int>")
    assert [r.p for r in df.select(AR.plurality_vote("v").alias("p")).collect()] == [1, 4, 2, 1]


def test_constant_column_and_one_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 1.0), (3.0, 5.0, 3.0)], "a double, c double, n double")
    assert E.constant_columns(df, ["a", "c", "n"]) == ["c"]
    out = E.standardize_samp(df, ["a", "c", "n"]).collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0]  # zero std replaced by 1
    assert out[0].n is None and math.isclose(out[2].n, 1 / math.sqrt(2))


def test_shift_one_lit_corner(spark):
    img = [1.0] + [0.0] * 8  # top-left lit, 3 x 3
    df = spark.createDataFrame([(img,)], "px array<float>")
    got = {k: df.select(AR.shift_grid("px", 3, dr, dc).alias("s")).first().s for k, (dr, dc) in AR.SHIFTS.items()}
    assert got["up"] == [0.0] * 9  # moved out of the top edge
    assert got["left"] == [0.0] * 9
    assert got["right"] == [0, 1.0, 0, 0, 0, 0, 0, 0, 0]
    assert got["down"] == [0, 0, 0, 1.0, 0, 0, 0, 0, 0]


def test_age_null_for_whole_title_and_age_18(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 18.0), ("b", None), ("b", 20.0)], "t string, Age double")
    out = P.fill_group_median(df, "Age", ["t"]).orderBy("t", "Age").collect()
    assert [r.Age for r in out if r.t == "a"] == [None, None]
    assert sorted(r.Age for r in out if r.t == "b") == [18.0, 19.0, 20.0]
    child = spark.createDataFrame([(18.0,)], "Age double").select(F.coalesce((F.col("Age") < 18).cast("int"), F.lit(0)).alias("c"))
    assert child.first().c == 0


def test_median_even_odd(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "v double")
    assert ID.exact_median(df, "v").first().median == 6.0
    df2 = spark.createDataFrame([(3.0,), (1.0,), (2.0,), (2.0,), (2.0,)], "v double")
    assert ID.exact_median(df2, "v").first().median == 2.0


def test_count_and_mean_skip_null_size_does_not(spark):
    df = spark.createDataFrame([("k", None), ("k", 2.0), ("k", 4.0)], "k string, v double")
    size = A.group_size(df, ["k"]).first()["size"]
    r = A.group_agg(df, ["k"], {"n": A.count_nonnull("v"), "m": F.avg("v")}).first()
    assert size == 3 and r.n == 2 and r.m == 3.0  # A2


def test_child_uses_imputed_age(spark):
    # A7: a NULL age filled from a young title group makes the row a child
    rows = [(1, "train", 1, "A, Master. x", "male", 5.0, 0, 0, 1, 10.0, None, "S"),
            (2, "train", 0, "A, Master. y", "male", None, 0, 0, 1, 10.0, None, "S"),
            (3, "test", None, "B, Mrs. z", "female", 40.0, 0, 0, 1, 10.0, None, "S")]
    p = spark.createDataFrame(rows, "row_id long, split string, Survived int, Name string, Sex string, Age double, "
                                    "SibSp int, Parch int, Pclass int, Fare double, Cabin string, Embarked string")
    p = p.withColumn("PassengerId", F.col("row_id"))
    f = {r.row_id: r for r in PS.passenger_features(p).collect()}
    assert f[2].Age == 5.0 and f[2].child == 1
    assert f[1].FamilyChildren == 2 and f[1].id == 1 and f[3].id == 2  # families numbered by first row
    assert f[3].FamilyWomen == 1.0 and f[3].Survived == 0  # test label filled with 0


def test_duplicates_on_columns_not_text(spark):
    # A9: ("1", 23) and ("12", 3) concatenate to the same text but are different rows
    df = spark.createDataFrame([("1", 23), ("12", 3), ("7", 7), ("7", 7)], "a string, b int")
    got = [r.IsDup for r in WN.duplicate_flag(df, ["a", "b"]).orderBy("a", "b").collect()]
    assert got == [0, 0, 1, 1]


def test_gbt_probability_from_margin(spark):
    # A13: sigmoid(2 * margin) is the binary boosted-tree probability
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array
    from tessera.operators import model as M
    df = spark.createDataFrame([(float(i % 2), float(i % 5), float(i % 3)) for i in range(60)], "label double, a double, b double")
    tr = M.assemble(df, ["a", "b"])
    m = GBTClassifier(maxIter=3, maxDepth=2, seed=1).fit(tr)
    out = m.transform(tr).select(vector_to_array("rawPrediction")[1].alias("margin"),
                                 vector_to_array("probability")[1].alias("p")).collect()
    for r in out:
        assert abs(1 / (1 + math.exp(-2 * r.margin)) - r.p) < 1e-12
