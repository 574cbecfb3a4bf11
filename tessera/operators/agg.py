"""Aggregations (AG1-AG17).

All are hash aggregates with map-side partial aggregation, so a key holding a
large share of the rows is combined before the shuffle. Group keys that are
NULL are dropped by default, as pandas' ``groupby`` does (A1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import exact_median


def _keyed(df: DataFrame, keys: Sequence[str], dropna: bool) -> DataFrame:
    if not dropna or not keys:
        return df
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def group_size(df: DataFrame, keys: Sequence[str], out: str = "size", dropna: bool = True) -> DataFrame:
    """AG1: rows per group (NULL values counted, NULL keys dropped)."""
    return _keyed(df, keys, dropna).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], dropna: bool = True) -> DataFrame:
    """Generic keyed aggregate: ``{out_name: aggregate expression}``."""
    return _keyed(df, keys, dropna).groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def count_nonnull(col: str) -> Column:
    """AG2."""
    return F.count(F.col(col))


def nunique(col: str, approx: bool = False, rsd: float = 0.05) -> Column:
    """AG3: distinct non-null values; ``approx`` uses HyperLogLog++ (no row expansion)."""
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))


def group_nunique(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], dropna: bool = True) -> DataFrame:
    """AG3: exact distinct non-null values of several columns (``{out_name: column}``) per group.

    Several distinct counts in one aggregate write every row once per column.
    Equal rows are collapsed first, map-side, so what is written several times is distinct rows only.
    """
    rows = list(dict.fromkeys([*keys, *cols.values()]))
    # a count that is asked for: the optimizer drops a plain distinct() below distinct counts
    d = _keyed(df, keys, dropna).groupBy(*rows).agg(F.count(F.lit(1)).alias("_equal")).where(F.col("_equal") > 0)
    return d.groupBy(*keys).agg(*[F.count_distinct(F.col(c)).alias(n) for n, c in cols.items()])


#: log2 of a distinct-count sketch's registers: a relative standard error of about 1.04 / sqrt(2 ** 12) = 1.6 %.
SKETCH_LG = 12


def distinct_sketches(df: DataFrame, keys: Sequence[str], cols: Sequence[str], lg_k: int = SKETCH_LG,
                      dropna: bool = True) -> DataFrame:
    """AG3, mergeable: per group one sketch per column (binary, bounded), to be stored and merged later.

    Null values are not counted; a group without values has an empty sketch.
    """
    d = _keyed(df, keys, dropna)
    return d.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c), F.lit(lg_k)).alias(c) for c in cols])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Sketches of finer groups (days, auctions) merged to those of ``keys``, as one pass over the rows would give."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(F.col(c)).alias(c) for c in cols])


def sketch_counts(sketches: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Distinct counts (``{out_name: sketch column}``) in place of the sketches."""
    names = set(cols.values())
    keep = [c for c in sketches.columns if c not in names]
    return sketches.select(*keep, *[F.hll_sketch_estimate(F.col(c)).alias(n) for n, c in cols.items()])


def first_in_order(col: str, order: str) -> Column:
    """AG8: value of the first row in ``order`` (NULL kept, A3)."""
    return F.min_by(F.col(col), F.col(order))


def last_in_order(col: str, order: str) -> Column:
    """AG9: value of the last row in ``order`` (NULL kept)."""
    return F.max_by(F.col(col), F.col(order))


def group_median(df: DataFrame, keys: Sequence[str], col: str, out: str = "median") -> DataFrame:
    """AG7: exact interpolating median per group, without collecting any group."""
    return exact_median(_keyed(df, keys, True), col, keys, out)


def global_median(df: DataFrame, col: str, out: str = "median") -> DataFrame:
    """AG13: one-row frame with the exact median of ``col``."""
    return exact_median(df, col, (), out)


def two_level_agg(df: DataFrame, outer: Sequence[str], inner: Sequence[str],
                  first: Mapping[str, Column], second: Mapping[str, Column]) -> DataFrame:
    """AG10: aggregate per (outer + inner) keys, then per outer keys.

    The first level combines map-side and shuffles on all its keys, so an
    outer key holding many rows is spread over its inner keys; the second
    level shuffles only the pre-aggregated rows.
    """
    keys = [*outer, *inner]
    lvl1 = _keyed(df, keys, True).groupBy(*keys).agg(*[e.alias(n) for n, e in first.items()])
    return lvl1.groupBy(*outer).agg(*[e.alias(n) for n, e in second.items()])


def winners(df: DataFrame, session: str, entity: str, order: str,
            winner: str = "winner_id", n_entities: str = "nofbidders") -> DataFrame:
    """AG9/AG16: per session the entity of its last row, and distinct entities."""
    return (_keyed(df, [session], True).groupBy(session)
            .agg(last_in_order(entity, order).alias(winner),
                 F.count_distinct(F.col(entity)).alias(n_entities)))


def wins_per_entity(win: DataFrame, winner: str = "winner_id", out_key: str = "bidder_id",
                    out: str = "nofwins", contested_col: str | None = None, min_entities: int = 2,
                    contested_out: str = "nofwins2") -> DataFrame:
    """AG12 (+AG11 when ``contested_col``): sessions won per entity; optionally also
    the wins among sessions with at least ``min_entities`` distinct entities,
    as a filtered count in the same pass."""
    aggs = [F.count(F.lit(1)).alias(out)]
    if contested_col:
        aggs.append(F.count(F.when(F.col(contested_col) >= min_entities, 1)).alias(contested_out))
    return _keyed(win, [winner], True).groupBy(winner).agg(*aggs).withColumnRenamed(winner, out_key)


def agg_having_regroup(win: DataFrame, cond: Column, key: str, out_key: str, out: str) -> DataFrame:
    """AG11: filter an aggregate's rows, then count per another key."""
    return (_keyed(win.where(cond), [key], True).groupBy(key)
            .agg(F.count(F.lit(1)).alias(out)).withColumnRenamed(key, out_key))


def global_stats(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """AG13: one-row frame of global aggregates."""
    return df.agg(*[e.alias(n) for n, e in aggs.items()])


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG14 wide form: one row, ``<col>_mean`` and ``<col>_std`` (sample) per column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    return df.agg(*aggs)


def array_moments(df: DataFrame, col: str, pos_out: str = "pos", mean_out: str = "mean",
                  std_out: str = "std") -> DataFrame:
    """AG14 array form: one row per element place (0-based) with its mean and sample std.

    Every place of every row counts, whatever the arrays' lengths; partial
    aggregates leave one row per place and task to shuffle.
    """
    e = df.select(F.posexplode(col).alias(pos_out, "_v"))
    v = F.col("_v").cast("double")
    return e.groupBy(pos_out).agg(F.avg(v).alias(mean_out), F.stddev_samp(v).alias(std_out))


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """AG15: frequency of each non-null value, most frequent first, then by value."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.col(out).desc(), F.col(col)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """AG16."""
    return df.select(col).distinct()


def group_mode_first_tie(df: DataFrame, keys: Sequence[str], col: str, order: str,
                         out: str = "mode") -> DataFrame:
    """AG17: most frequent value per group; ties go to the value seen first in ``order``."""
    per = (df.groupBy(*keys, col)
           .agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first")))
    return per.groupBy(*keys).agg(
        F.max_by(F.col(col), F.struct(F.col("_n"), -F.col("_first"))).alias(out))
