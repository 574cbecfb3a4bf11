"""Values at the edges: offsets, nulls, quotes, time zones, many categories, hot keys."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import encode as E
from tessera.operators import ids as ID
from tessera.operators import image as IM
from tessera.operators import prep as P
from tessera.operators import relate as R
from tessera.operators import window as WN
from tessera.session import scale_conf
from tessera.sources.csvio import scan_csv, scratch_dir, write_csv
from tessera.streaming.stateless import run_available


def f_value(rows):
    """One-way F of (class, value) rows."""
    groups = {}
    for c, v in rows:
        groups.setdefault(c, []).append(v)
    n, k = len(rows), len(groups)
    gm = sum(v for _, v in rows) / n
    b = sum(len(g) * (sum(g) / len(g) - gm) ** 2 for g in groups.values())
    w = sum((v - sum(g) / len(g)) ** 2 for g in groups.values() for v in g)
    return (b / (k - 1)) / (w / (n - k))


def test_anova_keeps_its_digits_under_an_offset(spark):
    rows = [(i % 3, (i % 3) * 0.7 + (i * 37 % 11) / 10) for i in range(90)]
    want = f_value(rows)
    for offset in (0.0, 1e9):
        df = spark.createDataFrame([(c, v + offset) for c, v in rows], "c int, x double")
        got = E.anova_f(df, ["x"], "c").first()["f_value"]
        assert math.isclose(got, want, rel_tol=1e-6)


def test_anova_counts_the_feature_not_the_rows(spark):
    rows = [(i % 2, float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows + [(0, None), (1, None), (2, None)], "c int, x double")
    got = E.anova_f(df, ["x"], "c").first()
    assert math.isclose(got["f_value"], f_value(rows), rel_tol=1e-9) and got["df_within"] == 38


def test_p_value_does_not_drift_with_the_row_count(spark):
    # four and very many degrees of freedom: P(F > f) -> exp(-2 f) * (1 + 2 f)
    want = math.exp(-3.0) * (1 + 3.0)
    for d2 in (1e9, 1e12):
        assert abs(E.f_survival(spark, 1.5, 4, d2) - want) < 1e-7


def test_fold_and_id_edges_with_null_keys(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(12)], "r int, y int")
    folds = ID.kfold_stratified(df, "y", ["r"], 3, "fold").collect()
    assert len(folds) == 12 and all(x["fold"] is not None for x in folds)
    ids = WN.dense_id_first_seen(df.withColumn("k", F.col("y")), ["k"], "r").collect()
    assert {x["id"] for x in ids if x["k"] is not None} == {1, 2}
    assert {x["id"] for x in ids if x["k"] is None} == {None}


def test_one_hot_of_odd_and_of_many_categories(spark):
    df = spark.createDataFrame([(i, f"v.{i}") for i in range(1100)], "r int, c string")
    out = E.one_hot(df.where("r < 3"), "c", "c")
    assert sorted(out.columns) == ["c", "c_v.0", "c_v.1", "c_v.2", "r"]
    assert out.agg(F.sum("`c_v.1`")).first()[0] == 1
    _, prior = E.fit_target_log_odds(df.withColumn("k", F.lit("a")), "k", "c")
    assert E.n_classes(prior) == 1100


def test_quotes_commas_and_line_breaks_in_csv(spark):
    rows = [(1, 'a "b", c'), (2, "x,y"), (3, "two\nlines"), (4, '"'), (5, "back\\slash")]
    path = scratch_dir(spark, "csv")
    write_csv(spark.createDataFrame(rows, "i int, s string"), path)
    back = scan_csv(spark, path, "i int, s string", multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_timestamps_are_read_without_a_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("no time",)], "s string")
        got = [r[0] for r in df.select(S.parse_timestamp("s").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-10 02:30:00", None]


def test_each_variant_has_its_own_angle(spark):
    df = spark.createDataFrame([(r, v) for r in range(50) for v in range(5)], "row_id int, variant int")
    a = df.withColumn("a", IM.rotation_angle(1, "row_id", "variant"))
    assert a.groupBy("row_id").agg(F.count_distinct("a").alias("n")).agg(F.max("n")).first()[0] > 1
    px = df.where("row_id = 0").withColumn("px", F.array(*[F.lit(float(i)) for i in range(16)]).cast("array<float>"))
    out = IM.augment_rotate(px.withColumn("width", F.lit(4)), key=("row_id", "variant"))
    assert out.select(F.hash("px")).distinct().count() > 1


def test_imputation_skips_incomplete_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)] + [(None, 5.0), (3.0, None), (None, None)],
                               "x double, y double")
    out = P.impute_regression(df, "y", ["x"], "p", fill=False).collect()
    for r in out:
        assert r["p"] is None if r["x"] is None else abs(r["p"] - (2 * r["x"] + 1)) < 1e-6


def test_right_join_and_key_sets_with_a_hot_key(spark):
    fact = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in range(300)], "k int, v int")
    ent = spark.createDataFrame([(i, i * 10) for i in range(0, 400, 2)] + [(1, 10), (None, 0)], "k int, e int")
    want = fact.join(ent, "k", "right")
    assert sorted(map(str, R.join_right(fact, ent, "k").select("k", "v", "e").collect())) == sorted(
        map(str, want.select("k", "v", "e").collect()))
    assert R.keys_only_new(ent.where("k is not null"), fact, "k").count() == ent.join(
        fact, "k", "left_anti").where("k is not null").select("k").distinct().count()


def test_sentinel_rows_meet_no_join(spark):
    df = spark.createDataFrame([("UNK" if i % 4 else f"c{i % 8}", i) for i in range(400)], "c string, s long")
    out = WN.leave_one_out_sentinel(df, "c", "s", "o", "UNK")
    assert out.count() == 400 and out.where("c = 'UNK'").agg(F.sum("o")).first()[0] == 0
    tot = {r["c"]: r["t"] for r in df.groupBy("c").agg(F.sum("s").alias("t")).collect()}
    for r in out.where("c <> 'UNK'").collect():
        assert r["o"] == tot[r["c"]] - r["s"]


def test_stream_over_a_folder_of_files(spark):
    path = scratch_dir(spark, "in")
    spark.range(100).repartition(4).write.parquet(path)
    out = run_available(spark, path, spark.read.parquet(path).schema, lambda d: d, uuid.uuid4().hex)
    assert spark.read.parquet(out).count() == 100


def test_partition_count_has_no_ceiling():
    assert int(scale_conf(10 ** 14)["spark.sql.shuffle.partitions"]) * (256 << 20) >= 10 ** 14


def test_vectors_of_differing_length_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "r int, px array<double>")
    with pytest.raises(ValueError):
        E.standardized_vectors(df, "px")
