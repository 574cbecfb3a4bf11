"""Order-dependent numbering without a single-partition window.

ID1  row_number_global   1-based row number over a unique order
ID2  row_index_reset     0-based row number
     prefix_sum          global running sum of a weight column
     group_row_number    row number within a group (hot groups stay split)
     exact_median        exact interpolating median, optionally per group
WN10 kfold_contiguous    K contiguous folds over a global order
WN11 kfold_stratified    K contiguous folds within each class

How the global numbering works: the rows are range-partitioned on the order
columns and sorted inside each partition. Each row gets (partition id,
position in partition) from ``monotonically_increasing_id``. That frame is
checkpointed to the shared checkpoint folder, so both reads below see the
same rows in the same places even if an executor is lost. The per-partition
counts form a table with one row per partition (bounded by the partition
count, so broadcasting it is safe). A prefix sum over that table gives
each partition's offset. No step puts the whole input into one task, and
a hot key is spread over several range partitions as long as the order is
unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import ensure_checkpoint_dir
from .relate import with_row

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged_positions(df: DataFrame, order: Sequence[str | Column],
                      num_partitions: int | None = None) -> DataFrame:
    """Range-partition, sort, tag (_pid, _pos), and checkpoint reliably."""
    ensure_checkpoint_dir(df.sparkSession)
    oc = _cols(order)
    ranged = df.repartitionByRange(_num_partitions(df, num_partitions), *oc).sortWithinPartitions(*oc)
    mid = F.monotonically_increasing_id()
    tagged = (ranged.withColumn("_mid", mid)
              .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK)))
              .drop("_mid"))
    return tagged.checkpoint(eager=True)


def _partition_offsets(tagged: DataFrame, weight: Column) -> DataFrame:
    """One row per partition: exclusive prefix of the partition totals."""
    per = tagged.groupBy("_pid").agg(F.sum(weight).alias("_tot"))
    w = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    # one row per range partition: the single-partition window is bounded
    return per.select("_pid", F.coalesce(F.sum("_tot").over(w), F.lit(0)).cast("long").alias("_off"))


def row_number_global(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """ID1: 1-based row number in the order given (the order must be unique)."""
    tagged = ranged_positions(df, order, num_partitions)
    offsets = _partition_offsets(tagged, F.lit(1))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_pos") + 1)
            .drop("_pid", "_pos", "_off"))


def row_index_reset(df: DataFrame, order: Sequence[str | Column], out: str = "index",
                    num_partitions: int | None = None) -> DataFrame:
    """ID2: 0-based row index (pandas ``index = range(len(df))``)."""
    return (row_number_global(df, order, "_rn1", num_partitions)
            .withColumn(out, F.col("_rn1") - 1).drop("_rn1"))


def prefix_sum(df: DataFrame, order: Sequence[str | Column], weight: str, out: str = "cum",
               num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` in a unique global order.

    Within a range partition the running sum is a window keyed on the
    partition id; the partitions are balanced by the range split, so no
    task gets more than its share.
    """
    tagged = ranged_positions(df, order, num_partitions)
    offsets = _partition_offsets(tagged, F.col(weight))
    w = W.partitionBy("_pid").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    return (tagged.withColumn("_in", F.sum(weight).over(w))
            .join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_in"))
            .drop("_pid", "_pos", "_off", "_in"))


def group_row_number(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                     out: str = "grn", num_partitions: int | None = None,
                     with_count: str | None = None) -> DataFrame:
    """Row number within each group of ``by`` (1-based), in ``order`` (unique within a group).

    Global numbering over (by, order), minus the group's first number. The
    group starts come from a partial aggregate, so a group holding a third of
    the rows is still spread over many tasks.
    """
    g = row_number_global(df, [*by, *order], "_g", num_partitions)
    stats = g.groupBy(*by).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_gn"))
    stats = stats.withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & g[c].eqNullSafe(stats[f"_by{i}"])      # a null group is a group
    res = (g.join(stats, same, "left").drop(*[f"_by{i}" for i in range(len(by))])
           .withColumn(out, F.col("_g") - F.col("_start") + 1))
    if with_count:
        res = res.withColumnRenamed("_gn", with_count)
    else:
        res = res.drop("_gn")
    return res.drop("_g", "_start")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median",
                 num_partitions: int | None = None) -> DataFrame:
    """Exact interpolating median of ``value`` (NULLs skipped), per group of ``by``.

    Equal values are first collapsed to (by, value, count) with a partial
    aggregate, then a weighted running count in (by, value) order finds the
    one or two middle values. No group is ever gathered into one buffer (as
    the percentile aggregate does). Groups whose values are all NULL are
    absent from the result.
    """
    compact = (df.where(F.col(value).isNotNull())
               .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))
    cum = prefix_sum(compact, [*by, value], "_c", "_cum", num_partitions)
    stats = cum.groupBy(*by).agg(F.min(F.col("_cum") - F.col("_c")).alias("_base"),
                                 F.sum("_c").alias("_n"))
    if by:
        j = cum.join(stats, list(by))
    else:
        j = with_row(cum, stats)  # one row
    hi = F.col("_cum") - F.col("_base")
    lo = hi - F.col("_c") + 1
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.ceil((F.col("_n") + 1) / 2)
    picked = j.where(((k1 >= lo) & (k1 <= hi)) | ((k2 >= lo) & (k2 <= hi)))
    v = F.col(value).cast("double")
    return picked.groupBy(*by).agg(
        ((F.max(F.when((k1 >= lo) & (k1 <= hi), v)) + F.max(F.when((k2 >= lo) & (k2 <= hi), v))) / 2)
        .alias(out))


def _fold_of(pos0: Column, n: Column, k: int) -> Column:
    """Fold number 0..k-1 for 0-based position pos0 of n rows: the first n % k
    folds hold one row more (contiguous, as a KFold without shuffling)."""
    q = F.floor(n / k)
    r = n % k
    big = r * (q + 1)
    return F.when(pos0 < big, F.floor(pos0 / (q + 1))).otherwise(r + F.floor((pos0 - big) / q)).cast("int")


def kfold_contiguous(df: DataFrame, order: Sequence[str | Column], k: int = 3,
                     out: str = "fold", num_partitions: int | None = None) -> DataFrame:
    """WN10: contiguous folds over the global order (same as ``ntile(k)`` minus one)."""
    g = row_number_global(df, order, "_rn", num_partitions)
    n = g.agg(F.count(F.lit(1)).alias("_n"))
    return (with_row(g, n)
            .withColumn(out, _fold_of(F.col("_rn") - 1, F.col("_n"), k))
            .drop("_rn", "_n"))


def kfold_stratified(df: DataFrame, label: str, order: Sequence[str | Column], k: int = 3,
                     out: str = "fold", num_partitions: int | None = None) -> DataFrame:
    """WN11: contiguous folds within each class (per-class ``ntile(k)`` minus one)."""
    g = group_row_number(df, [label], order, "_grn", num_partitions, with_count="_gn")
    return (g.withColumn(out, _fold_of(F.col("_grn") - 1, F.col("_gn"), k))
            .drop("_grn", "_gn"))
