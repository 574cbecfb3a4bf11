"""Operator 1, line dedup: range-partitioned line hashes, streamed first occurrences.

The lines of every text (split at \\n) become narrow rows: a 128-bit hash of
the line's key, the document, the line's place. These rows are
range-partitioned by (hash, document, place) and sorted inside each
partition, so that the occurrences of a key stand together, the smallest
doc_id first. One streaming pass over each partition then names the
occurrences outside that first document. A key that very many documents hold
spans several partitions; as a partition cannot know where such a run began,
its head run is passed on as pending, together with the first document it
saw, and is settled against the (at most two per partition) run heads.

The result is a zlib-compressed keep bitmap per document that loses lines (bit
i: line i stays), not text. ``apply_bitmaps`` puts bitmaps and texts together;
it is the only step that shuffles texts.

Defined results: null and empty text have one empty line, which stays; a key
shorter than ``min_chars`` is never dropped; all lines of a key stay in the
smallest doc_id that holds it, repeats included; a null doc_id is larger than
all others; rows that repeat a doc_id are one document for the rule, and rows
that repeat its text too get the same bitmap; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from .common import WS, small_batches, staged, text_of

MIN_CHARS = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DROP, _PENDING, _HEAD = 0, 1, 2
_FOUND = "kind int, h1 long, h2 long, doc_id long, row long, pos int, n_lines int"


def line_key(line: str | Column) -> Column:
    """The line stripped of white space at both ends, A-Z lower-cased."""
    c = F.col(line) if isinstance(line, str) else line
    return F.translate(F.btrim(c, F.lit(WS)), UPPER, LOWER)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, row, pos, n_lines) of each line whose key is long enough.

    ``row`` is a hash of the whole text: it tells rows of one doc_id apart.
    """
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    t = t.select("doc_id", F.xxhash64("t").alias("row"), F.split("t", "\n", -1).alias("lines"))
    t = t.select("doc_id", "row", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    t = t.withColumn("key", line_key("line")).where(F.char_length("key") >= min_chars)
    return t.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("2"), "key").alias("h2"),
                    "doc_id", "row", "pos", "n_lines")


def _stream_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First occurrences over one sorted partition; see the module text."""
    names = ["kind", "h1", "h2", "doc_id", "row", "pos", "n_lines"]
    head = None          # key of the partition's first run
    last = None          # (key, first doc, its null flag) of the run in progress

    def out(kind, cols, null):
        kinds = np.full(len(cols[0]), kind, np.int32)
        arrays = [pa.array(kinds)] + [pa.array(c) for c in cols]
        arrays[3] = pa.array(cols[2], mask=null)
        return pa.RecordBatch.from_arrays(arrays, names)

    def mark(run):
        (h1, h2), doc, null = run
        one = [np.array([x], np.int64) for x in (h1, h2, doc, 0)] + [np.zeros(1, np.int32)] * 2
        return out(_HEAD, one, np.array([null]))

    for b in batches:
        if not b.num_rows:
            continue
        c = {f: b.column(i) for i, f in enumerate(b.schema.names)}
        null = c["doc_id"].is_null().to_numpy(zero_copy_only=False)
        doc = c["doc_id"].fill_null(0).to_numpy()
        h1, h2, row, pos, n = (c[f].to_numpy() for f in ("h1", "h2", "row", "pos", "n_lines"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = last is None or last[0] != (h1[0], h2[0])
        if head is None:
            head = (h1[0], h2[0])
        start = np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))
        goes_on = start < 0
        first = np.where(goes_on, last[1] if last else 0, doc[start])
        first_null = np.where(goes_on, last[2] if last else False, null[start])
        in_head = (h1 == head[0]) & (h2 == head[1])
        drop = ((doc != first) | (null != first_null)) & ~in_head
        for kind, sel in ((_DROP, drop), (_PENDING, in_head)):
            if sel.any():
                yield out(kind, [x[sel] for x in (h1, h2, doc, row, pos, n)], null[sel])
        run = ((h1[-1], h2[-1]), first[-1], bool(first_null[-1]))
        if last is not None and last[0] == head and run[0] != head:
            yield mark(last)
        elif last is None and run[0] != head:
            yield mark((head, doc[0], bool(null[0])))
        last = run
    if last is not None:
        yield mark(last)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, pos, n_lines) of each line that goes."""
    spark = docs.sparkSession
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").asc_nulls_last(), F.col("row"), F.col("pos")]
    rows = line_rows(docs, id_col, text_col, min_chars)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = staged(ranged.mapInArrow(_stream_runs, _FOUND), "line-runs")
    cols = ["doc_id", "row", "pos", "n_lines"]
    heads = (found.where(F.col("kind") == _HEAD).groupBy("h1", "h2")
             .agg(F.min("doc_id").alias("first_doc")))      # min skips nulls: a null id is last
    # at most two run heads per range partition: a size that the partition count bounds
    pending = found.where(F.col("kind") == _PENDING).join(F.broadcast(heads), ["h1", "h2"])
    pending = pending.where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    return found.where(F.col("kind") == _DROP).select(*cols).unionByName(pending.select(*cols))


@F.pandas_udf(BinaryType())
def _bitmap(pos: pd.Series, n_lines: pd.Series) -> pd.Series:
    def one(p, n):
        keep = np.ones(n, bool)
        keep[p] = False
        return zlib.compress(np.packbits(keep).tobytes(), 6)
    return pd.Series([one(p, n) for p, n in zip(pos, n_lines)], dtype=object)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, n_lines, n_dropped, keep_bitmap) of each document that loses lines."""
    per = (dropped_lines(docs, id_col, text_col, min_chars)
           .groupBy("doc_id", "row")
           .agg(F.collect_set("pos").alias("gone"), F.first("n_lines").alias("n_lines")))
    return per.select("doc_id", "row", F.col("n_lines").cast("long").alias("n_lines"),
                      F.size("gone").cast("long").alias("n_dropped"),
                      _bitmap("gone", "n_lines").alias("keep_bitmap"))


@F.pandas_udf(StringType())
def _kept_lines(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(t, m):
        if m is None:
            return None
        lines = t.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(m), np.uint8), count=len(lines))
        return "\n".join([x for x, k in zip(lines, keep) if k])
    return pd.Series([one(t, m) for t, m in zip(text, bitmap)], dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, text without the dropped lines, n_lines, n_dropped), one row per document.

    Only texts that lose lines go through Python.
    """
    small_batches(docs.sparkSession)
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    t = t.withColumn("row", F.xxhash64("t"))
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("row").alias("b_row"), "n_dropped", "keep_bitmap")
    j = t.join(b, t["doc_id"].eqNullSafe(b["b_id"]) & (t["row"] == b["b_row"]), "left")
    cut = F.col("keep_bitmap").isNotNull()
    j = j.withColumn("kept", _kept_lines(F.when(cut, F.col("t")), "keep_bitmap"))
    return j.select("doc_id", F.when(cut, F.col("kept")).otherwise(F.col("t")).alias("text"),
                    (F.char_length("t") - F.char_length(F.translate("t", "\n", "")) + 1)
                    .cast("long").alias("n_lines"),
                    F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
