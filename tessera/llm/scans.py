"""Running counts, sums and hashes within groups, however large a group is.

A window over a group brings the group into one task. Here the rows are
range-partitioned and sorted on (group, order), so a large group spans several
partitions; each partition runs through its own rows, and what runs on from
one partition to the next is one row per partition, added by arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


def _running(op: np.ufunc, v: np.ndarray, start: np.ndarray, before) -> np.ndarray:
    """Inclusive running ``op`` within stretches that begin at ``start``; the first takes over ``before``."""
    out = op.accumulate(v)
    base = np.zeros(len(v), v.dtype)
    later = start > 0
    base[later] = out[start[later] - 1]
    if op is np.add:
        out = out - base
        out[start == 0] += before
        return out
    out = out ^ base
    out[start == 0] ^= before
    return out


def _tag(sums: Sequence[str], xors: Sequence[str]):
    cols = [*[(c, np.add) for c in sums], *[(c, np.bitwise_xor) for c in xors]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        held = None          # the rows before, whose last one waits to learn whether its group goes on
        prev, groups, count, upto = None, 0, 0, {c: np.int64(0) for c, _ in cols}

        def out(x, goes_on):
            batch, ordinal, n, last, runs = x
            unknown = np.zeros(len(last), bool)
            unknown[-1] = goes_on is None
            last[-1] = not goes_on
            flags = pa.array(last, mask=unknown)
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(n), pid, np.int64)), pa.array(ordinal), pa.array(n), flags,
                 *[pa.array(r) for r in runs]],
                [*batch.schema.names, "_pid", "_ord", "_n", "_last", *[f"_c_{c}" for c, _ in cols]])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            goes_on = prev is not None and key[0] == prev
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            where = np.flatnonzero(new)
            start = where[np.cumsum(new) - 1]
            new[0] = not goes_on
            ordinal = groups - 1 + np.cumsum(new)
            n = np.arange(len(key)) - start + 1
            n[start == 0] += count if goes_on else 0
            runs = [_running(op, batch.column(c).to_numpy().astype(np.int64), start,
                             upto[c] if goes_on else np.int64(0)) for c, op in cols]
            last = np.zeros(len(key), bool)
            last[:-1] = key[1:] != key[:-1]
            if held is not None:
                yield out(held, goes_on)
            held = (batch, ordinal, n, last, runs)
            prev, groups, count = key[-1], int(ordinal[-1]) + 1, int(n[-1])
            upto = {c: r[-1] for (c, _), r in zip(cols, runs)}
        if held is not None:
            yield out(held, None)
    return run


def group_scan(df: DataFrame, group: str, order: Sequence[Column | str], sums: Sequence[str] = (),
               xors: Sequence[str] = (), name: str = "scan") -> DataFrame:
    """``df`` (first column: ``group``, a long that is never null) with, in ``order`` within each group:

    ``n`` (1-based number), ``last`` (whether it is the group's last row),
    ``ordinal`` (the group's 0-based number among all groups, ascending) and
    ``cum_<c>``, the running sum or exclusive-or up to and with the row, of
    each long column ``c`` of ``sums`` and ``xors``.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df.select(group, *[c for c in df.columns if c != group])
    by = [F.col(group), *order]
    ranged = df.repartitionByRange(width, *by).sortWithinPartitions(*by)
    cum = [*sums, *xors]
    fields = "".join(f", _c_{c} long" for c in cum)
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
              + ", _pid long, _ord long, _n long, _last boolean" + fields)
    t = staged(ranged.mapInArrow(_tag(sums, xors), schema), name)
    # one row per range partition
    ends = t.groupBy("_pid").agg(F.min(group).alias("first"), F.max("_ord").alias("top"),
                                 F.max(F.struct(group, "_n", *[f"_c_{c}" for c in cum])).alias("end"))
    rows = sorted(ends.collect())
    add, skip, carry = [], 0, (None, 0, *[0] * len(cum))
    for i, r in enumerate(rows):
        goes_on = carry[0] == r["first"]
        skip -= goes_on                       # its first group was counted before
        own = carry[1:] if goes_on else (0,) * (1 + len(cum))
        after = rows[i + 1]["first"] if i + 1 < len(rows) else None
        add.append((r["_pid"], r["first"], skip, after, *own))
        skip += r["top"] + 1
        end = tuple(r["end"])
        if goes_on and end[0] == r["first"]:
            end = (end[0], end[1] + own[0], *[a + b for a, b in zip(end[2:2 + len(sums)], own[1:])],
                   *[a ^ b for a, b in zip(end[2 + len(sums):], own[1 + len(sums):])])
        carry = end
    heads = spark.createDataFrame(add, "_pid long, _first long, _skip long, _after long, _m long"
                                  + "".join(f", _b_{c} long" for c in cum))
    cont = F.col(group) == F.col("_first")
    zero = F.lit(0).cast("long")

    def on(c):
        return F.when(cont, F.col(c)).otherwise(zero)
    got = t.join(F.broadcast(heads), "_pid")
    return got.select(
        *df.columns, (F.col("_n") + on("_m")).alias("n"), (F.col("_ord") + F.col("_skip")).alias("ordinal"),
        F.coalesce(F.col("_last"), ~F.col("_after").eqNullSafe(F.col(group))).alias("last"),
        *[(F.col(f"_c_{c}") + on(f"_b_{c}")).alias(f"cum_{c}") for c in sums],
        *[F.col(f"_c_{c}").bitwiseXOR(on(f"_b_{c}")).alias(f"cum_{c}") for c in xors])
