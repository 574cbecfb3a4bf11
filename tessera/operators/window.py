"""Window and order-dependent operators (WN1-WN12).

Group totals on every row are computed as a partial aggregate joined back
rather than as a window over the group: a window puts each group into one
task, while the aggregate is combined map-side and the join's hot detail
side is split by AQE skew handling. Only the lag (WN1) needs the rows of a
group in order; it works on sorted range partitions, and a partition's first
row looks at the last row of the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .ids import group_row_number, ranged_positions, row_number_global
from .relate import count_join_back


def lag_in_group(df: DataFrame, keys: Sequence[str], order: str, col: str, out: str,
                 offset: int = 1) -> DataFrame:
    """WN1: previous value of ``col`` within the group, in ``order`` (unique).

    Rows are range-partitioned and sorted on (keys, order); the lag is taken
    inside each range partition, and a partition's first row looks at the last
    row of the partition before it (one row per partition, broadcast). It holds
    when that row has the same keys. A group with a large share of all rows
    spans several range partitions, so it is never met by one task, and there
    is no self-join. Larger offsets look the row number up instead.
    """
    names = [f"_lk{i}" for i in range(len(keys))]
    if offset != 1:
        g = row_number_global(df, [*keys, order], "_lg")
        prev = g.select((F.col("_lg") + offset).alias("_lg"), *[F.col(k).alias(n) for k, n in zip(keys, names)],
                        F.col(col).alias("_lv"))
        same = _same_keys(keys, names)
        return g.join(prev, "_lg", "left").withColumn(out, F.when(same, F.col("_lv"))).drop("_lg", "_lv", *names)
    tagged = ranged_positions(df, [*keys, order])
    before = F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(col).alias("_lv"))
    tails = tagged.groupBy("_pid").agg(F.max_by(before, F.col("_pos")).alias("_row"))
    # one row per range partition: the window and the broadcast are as small as their number
    heads = tails.select("_pid", F.lag("_row").over(W.orderBy("_pid")).alias("_tail"))
    w = W.partitionBy("_pid").orderBy("_pos")
    d = (tagged.withColumn("_row", F.lag(before).over(w)).join(F.broadcast(heads), "_pid", "left")
         .withColumn("_row", F.coalesce("_row", "_tail")))
    d = d.withColumns({n: F.col(f"_row.{n}") for n in [*names, "_lv"]})
    return (d.withColumn(out, F.when(F.col("_row").isNotNull() & _same_keys(keys, names), F.col("_lv")))
            .drop("_pid", "_pos", "_row", "_tail", "_lv", *names))


def _same_keys(keys: Sequence[str], names: Sequence[str]) -> Column:
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return same


def time_since_prev(df: DataFrame, keys: Sequence[str], order: str, time_col: str,
                    out: str = "timediff", lag_out: str | None = None) -> DataFrame:
    """WN2: ``time - previous time`` in the group; microseconds for timestamps."""
    lag_name = lag_out or "_lag"
    d = lag_in_group(df, keys, order, time_col, lag_name)
    if dict(d.dtypes)[time_col].startswith("timestamp"):
        diff = F.timestamp_diff("MICROSECOND", F.col(lag_name), F.col(time_col))
    else:
        diff = F.col(time_col) - F.col(lag_name)
    d = d.withColumn(out, diff)
    return d if lag_out else d.drop(lag_name)


def group_sum_broadcast(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """WN3: the group's sum of ``col`` on every row (aggregate + join back).

    Rows with a NULL key get NULL, like a lookup of a missing key.
    """
    tot = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(col).alias(out))
    return df.join(tot, key, "left")


def leave_one_out_sum(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """WN4: group sum minus the row's own value."""
    return (group_sum_broadcast(df, key, col, "_gs")
            .withColumn(out, F.col("_gs") - F.col(col)).drop("_gs"))


def leave_one_out_sentinel(df: DataFrame, key: str, col: str, out: str, sentinel: str) -> DataFrame:
    """WN5: as WN4, but rows of the sentinel group (the huge "unknown" key) get 0.

    The sentinel rows take a branch of their own and meet neither the
    aggregate nor the join, so the biggest group is never shuffled.
    """
    is_s = F.col(key).eqNullSafe(F.lit(sentinel))
    rest = leave_one_out_sum(df.where(~is_s), key, col, out)
    kind = dict(rest.dtypes)[out]
    return rest.unionByName(df.where(is_s).withColumn(out, F.lit(0).cast(kind)))


def duplicate_flag(df: DataFrame, cols: Sequence[str], out: str = "IsDup", hashed: bool = False) -> DataFrame:
    """WN6: 1 on every row whose values in ``cols`` occur more than once (NULLs equal).

    Wide keys join on (64-bit hash, struct of the columns): the hash spreads
    the rows, the struct comparison means a collision cannot flag a row.
    """
    keys = list(cols)
    if hashed and len(keys) <= 3:
        d = df.withColumn("_dh", F.xxhash64(*cols))
        res = count_join_back(d, ["_dh", *keys], "_dupn").drop("_dh")
    else:
        res = count_join_back(df, keys, "_dupn")  # wide keys are hashed there
    return res.withColumn(out, (F.col("_dupn") > 1).cast("int")).drop("_dupn")


def same_place_count(df: DataFrame, cols: Sequence[str], out: str = "nofcrimes",
                     count_col: str | None = None) -> DataFrame:
    """WN7: number of rows sharing the composite key (no text concatenation, A9)."""
    return count_join_back(df, cols, out, count_col)


def dense_id_first_seen(df: DataFrame, key: Sequence[str], order: str, out: str = "id") -> DataFrame:
    """WN8/SO5: 1, 2, ... per distinct key in order of its first row.

    One row per key with its first position (partial aggregate), numbered by
    the global row numbering, joined back.
    """
    keyed = df
    for k in key:
        keyed = keyed.where(F.col(k).isNotNull())   # rows without a key get no id
    first = keyed.groupBy(*key).agg(F.min(order).alias("_first"))
    ids = row_number_global(first, ["_first"], out).drop("_first")
    return df.join(ids, list(key), "left")


def rare_group_collapse(id_col: str | Column, size_col: str | Column, min_size: int = 3,
                        code: int = -1) -> Column:
    """WN9: the group id, or ``code`` where the group size is below ``min_size``."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    s = F.col(size_col) if isinstance(size_col, str) else size_col
    return F.when(s < min_size, F.lit(code)).otherwise(i)


def stratified_split(df: DataFrame, label: str, row_id: str, train_size: float = 0.5,
                     test_size: float = 0.1, seed: int = 1, out: str = "part") -> DataFrame:
    """WN12: stratified shuffle split, as a column 'train' / 'test' / NULL (unused).

    Each class is ordered by a seeded hash of the row id; the first
    round(train_size * n_c) rows are train, the next round(test_size * n_c)
    are test. The counts are exact per class; the draw is repeatable
    regardless of partitioning.
    """
    h = F.xxhash64(F.lit(seed), F.col(row_id))
    g = group_row_number(df.withColumn("_h", h), [label], ["_h", row_id], "_r", with_count="_cn")
    n_tr = F.round(F.col("_cn") * train_size)
    n_te = F.round(F.col("_cn") * test_size)
    return (g.withColumn(out, F.when(F.col("_r") <= n_tr, F.lit("train"))
                         .when(F.col("_r") <= n_tr + n_te, F.lit("test")))
            .drop("_h", "_r", "_cn"))
