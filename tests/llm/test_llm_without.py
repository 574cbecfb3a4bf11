"""Rows dropped without a shuffle of the others' texts."""

from pyspark.sql import functions as F

from tessera.llm import exact_dedup
from tessera.llm.common import without


def test_without_is_the_anti_join(spark):
    docs = spark.createDataFrame([(i if i % 50 else None, "t" * (i % 7), i) for i in range(1000)],
                                 "doc_id long, text string, _mark_bits long")
    gone = spark.createDataFrame([(i, "t" * (i % 5)) for i in range(0, 1000, 3)] + [(None, "t")], "gid long, gt string")
    on = F.col("doc_id").eqNullSafe(F.col("gid")) & (F.col("text") == F.col("gt"))
    want = docs.join(gone, on, "left_anti")
    got = without(docs, gone, F.col("doc_id"), "gid", on)
    assert got.columns == docs.columns
    assert 0 < got.count() < 1000 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert without(docs, gone.limit(0), F.col("doc_id"), "gid", on).count() == 1000


def test_texts_without_copies_are_not_shuffled(spark, tmp_path):
    rows = 4000
    text = F.concat(F.sha2(F.col("id").cast("string"), 512), F.when(F.col("id") % 20 == 0, "").otherwise(F.repeat(F.lit("x"), 20)))
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 20 == 0, F.lit("copy")).otherwise(text).alias("text"))
    docs.write.parquet(str(tmp_path / "docs"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # as for a table too large to broadcast
        out = exact_dedup.drop_exact_copies(spark.read.parquet(str(tmp_path / "docs")))
        assert out.count() == rows - rows // 20 + 1
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = exact_dedup.drop_exact_copies(spark.read.parquet(str(tmp_path / "docs")))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan.split("Union", 1)[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
