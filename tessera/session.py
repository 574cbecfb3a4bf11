"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Session with the settings every operator here assumes.

    timeZone UTC, ANSI on (Spark default), AQE with partition coalescing and
    skew-join splitting on, Arrow on for the few pandas batch operators, UI off.
    ``input_bytes`` sizes scans and shuffles for the data volume (``scale_conf``).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.ansi.enabled": "true",
        # checkpoint files of the numbering operators are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "16g"
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session configuration and is
    used as is. Where it is unset, a local master (tests) gets a scratch
    folder; any other master is an error, as its executors would not share one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Make this package's functions usable in the Python workers.

    The operators that run Python on executors (the image rotation, the block
    fits) reference functions of this package. They are pickled by
    value into the task closures, so workers need no copy of the package and
    no file is written anywhere.
    """
    from pyspark import cloudpickle

    import tessera

    if not getattr(ship_package, "_done", False):
        cloudpickle.register_pickle_by_value(tessera)
        ship_package._done = True


def prepare_session(spark: SparkSession) -> SparkSession:
    """Checkpoint folder + package shipping: what every entry point needs."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a given input size (e.g. 100 TB on a large cluster).

    Scans split files at ``target_partition_bytes``. Shuffles start with one
    partition per target size (200 at least), and AQE coalesces small ones toward the same advisory size at run time.
    Partitions of that size fit executor memory, and sorts and aggregates
    spill beyond it.
    """
    n = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }

