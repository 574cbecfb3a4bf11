"""Session rules: the shared checkpoint folder is read, never overridden; sizing bounds."""

from tessera.session import ensure_checkpoint_dir, scale_conf


def test_checkpoint_dir_is_kept(spark):
    before = spark.conf.get("spark.checkpoint.dir")
    assert before
    assert ensure_checkpoint_dir(spark) == before
    assert spark.conf.get("spark.checkpoint.dir") == before


def test_scale_conf_bounds():
    tb = 1 << 40
    big = scale_conf(100 * tb)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * tb // (256 << 20)  # grows with the input
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"  # floor
    mid = int(scale_conf(tb)["spark.sql.shuffle.partitions"])
    assert mid == tb // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
