"""Joins, set operations, sorts and limits (JN1-JN8, ST1-ST6, SO1-SO5).

Broadcast is only forced where the side has a size bound by construction
(one row, or one row per partition). Learned lookup tables are joined
plainly: AQE switches such a join to broadcast at runtime when the measured
size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a
shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (global statistics, fitted
    coefficients, a prior vector) to every row of ``df``.

    The single row is broadcast and matched to every row: no row is
    multiplied, the detail side is never shuffled, and the broadcast is one
    row by construction. Callers pass only aggregates without grouping keys
    (or other frames of exactly one row).
    """
    return df.crossJoin(F.broadcast(one_row))


def join_right(fact: DataFrame, entity: DataFrame, key: str) -> DataFrame:
    """JN1: every entity row kept, facts matched on ``key``.

    Matches by an inner join, whose hot fact key AQE can split (it cannot in a
    right outer join), and the entities without facts by an anti join on the
    distinct fact keys.
    """
    out = fact.join(entity, key)
    alone = entity.join(fact.select(key).distinct(), key, "left_anti")
    return out.unionByName(alone, allowMissingColumns=True)


def join_left_chain(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """JN2: successive left joins on one key (exchanges on the key are reused)."""
    out = base
    for o in others:
        out = out.join(o, key, "left")
    return out


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """``df`` written bucketed and sorted by ``key``, read back as a table that knows its layout.

    Tables of equal key and bucket count are joined, and aggregated by the key,
    without another exchange: the shuffle is paid once, when the table is written. The
    table is external, in the shared checkpoint folder, one file per bucket.
    """
    import uuid

    from ..session import scratch_path
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    # dealt by the key first, so each task writes its own buckets and a bucket is one file
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def join_left_stored(base: DataFrame, others: Sequence[DataFrame], key: str, buckets: int) -> DataFrame:
    """JN2 over stored layouts: every table bucketed by the key, then a chain of joins without an exchange."""
    return join_left_chain(write_bucketed(base, key, buckets), [write_bucketed(o, key, buckets) for o in others], key)


def count_join_back(df: DataFrame, keys: Sequence[str], out: str = "n", count_col: str | None = None) -> DataFrame:
    """JN3/WN7: count of rows (or non-null ``count_col``) sharing ``keys``, on every row.

    Aggregate (map-side partial counts) then join back; NULL keys match
    each other (null-safe), as a group-by treats them. A hot key holds one
    row on the count side; AQE splits the detail side of a skewed join.
    """
    cnt = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    if len(keys) > 3:
        # many key columns: one struct key (plus a hash to spread it), so the
        # join carries two conditions instead of one per column
        d = df.withColumns({"_kh": F.xxhash64(*keys), "_ks": F.struct(*keys)})
        agg = d.groupBy("_kh", "_ks").agg(cnt.alias(out)).withColumnsRenamed({"_kh": "_kh2", "_ks": "_ks2"})
        cond = [d["_kh"] == agg["_kh2"], d["_ks"].eqNullSafe(agg["_ks2"])]
        return d.join(agg, cond, "left").drop("_kh", "_ks", "_kh2", "_ks2")
    agg = df.groupBy(*keys).agg(cnt.alias(out))
    ren = {k: f"_k_{i}" for i, k in enumerate(keys)}
    agg = agg.withColumnsRenamed(ren)
    cond = [df[k].eqNullSafe(agg[ren[k]]) for k in keys]
    return df.join(agg, cond, "left").drop(*ren.values())


def lookup_join(df: DataFrame, table: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """JN4: learned key -> value(s) lookup as a left join."""
    return df.join(table, key, "left")


def align_by_row_id(left: DataFrame, right: DataFrame, row_id: str = "row_id") -> DataFrame:
    """JN5: horizontal alignment of two frames of the same rows by an explicit id."""
    return left.join(right, row_id, "inner")


def keys_only_new(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """JN6: distinct keys present in ``new`` but not in ``old``."""
    return new.select(key).distinct().join(old.select(key).distinct(), key, "left_anti")


def keys_only_old(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """JN7: distinct keys present in ``old`` but not in ``new``."""
    return keys_only_new(old, new, key)


def keys_in_both(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """JN8: distinct keys present in both."""
    return new.select(key).distinct().join(old.select(key).distinct(), key, "left_semi")


def union_tagged(frames: Sequence[tuple[str, DataFrame]], tag: str = "split") -> DataFrame:
    """ST1: stack frames with a tag column; columns missing in a frame become NULL."""
    out = None
    for name, f in frames:
        t = f.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def split_by_tag(df: DataFrame, value: str, tag: str = "split") -> DataFrame:
    """ST2."""
    return df.where(F.col(tag) == value)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """ST3: distinct union of two key sets."""
    return a.union(b).distinct()


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """ST4: distinct rows of ``a`` not in ``b`` (SQL EXCEPT)."""
    return a.subtract(b)


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """ST5: distinct rows in both (SQL INTERSECT)."""
    return a.intersect(b)


def sorted_distinct(df: DataFrame, key: str) -> DataFrame:
    """SO1: distinct keys in ascending order (range-partitioned sort)."""
    return df.select(key).distinct().orderBy(key)


def agg_sorted(df: DataFrame, key: str) -> DataFrame:
    """SO2: aggregate output in key order, as pandas' ``groupby`` returns it."""
    return df.orderBy(key)


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """SO3: first n rows in an explicit order (top-n, no full sort)."""
    return df.orderBy(*order).limit(n)


def topk(df: DataFrame, score: str, name: str, k: int) -> DataFrame:
    """SO4: k rows with the largest score, ties by name."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(name)).limit(k)
