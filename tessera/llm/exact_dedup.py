"""Operator 2, exact dedup: length, then prefix hash, then full hash.

Texts are equal when they are identical after every white-space character
(``[\\x20\\x09-\\x0D]``) is deleted. One pass over the texts writes a narrow
key table (id, lengths, prefix hash, SHA-256); texts are never shuffled. The
groups are then refined step by step: only rows that share their length with
another row go on to be grouped by prefix hash, and only those that share the
prefix hash too take part in the grouping by full hash. Spark reads a text
column whole or not at all and the digest is part of the result for every
row, so the digest is taken in the same pass that takes the length; what the
refinement saves is the shuffling of wide keys.

Counts collapse on the map side, and the joins back to the rows are plain
sort-merge joins whose large side AQE splits, so a group of copies that holds
a third of all rows is not gathered in one task.

Defined results: null text = empty text (all empty texts are one group);
repeated rows (same doc_id and text) share their verdict; a null doc_id sorts
after all others; an empty table gives an empty result.

All of it is DataFrame expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, quoted, staged, text_of, unused, without

PREFIX_CHARS = 64


def key_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              prefix_chars: int = PREFIX_CHARS, raw: bool = False) -> DataFrame:
    """(doc_id, chars, norm_len, prefix_hash, digest): all that refinement needs; ``raw`` adds the whole text's digest."""
    own = [F.unhex(F.sha2("t", 256)).alias("raw")] if raw else []
    t = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    n = t.select("doc_id", F.char_length("t").cast("long").alias("chars"),
                 F.translate("t", WS, "").alias("norm"), *own)
    return n.select("doc_id", "chars", F.char_length("norm").alias("norm_len"),
                    F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix_hash"),
                    F.unhex(F.sha2("norm", 256)).alias("digest"), *(["raw"] if raw else []))


def _shared(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose ``by`` values occur in at least one more row."""
    many = (rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select(*by))
    # written first: the join then stands on two plain exchanges, whose large partitions AQE splits
    return rows.join(staged(many, "exact-groups"), by, "left_semi")


def _grouped(keys: DataFrame) -> DataFrame:
    """``keys`` with their group's size ``n`` (null: no other row has the text) and its best row ``b``."""
    by_len = staged(_shared(keys, ["norm_len"]), "exact-len")
    by_prefix = staged(_shared(by_len, ["norm_len", "prefix_hash"]), "exact-prefix")
    full = ["norm_len", "prefix_hash", "digest"]
    raw = ["raw"] if "raw" in keys.columns else []
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("z"),
                          F.col("doc_id").alias("i"), *raw))
    groups = (by_prefix.groupBy(*full)
              .agg(F.count(F.lit(1)).alias("n"), best.alias("b"))
              .where(F.col("n") > 1)
              .select(*full, "n", "b"))
    return keys.join(staged(groups, "exact-groups"), full, "left")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest.

    ``keep_id`` is the id of the row with the most code points in the original
    text, then the smallest doc_id, among equal texts.
    """
    out = _grouped(staged(key_table(docs, id_col, text_col), "exact-keys"))
    alone = F.col("n").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("b.i")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("b.i"))
                  & (F.col("chars") == -F.col("b.c")))).alias("kept"),
        "digest")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each text; columns unchanged.

    The row that stays is the one ``exact_groups`` keeps; of several such rows
    (they share their doc_id, which may be null) that with the least digest of
    the whole text, and any one of rows equal in that too. Rows are dropped by
    doc_id and digest, so another text of the same doc_id stays. Texts are shuffled
    only of rows whose doc_id may be one of those (``without``).
    """
    keys = _grouped(staged(key_table(docs, id_col, text_col, raw=True), "exact-keys"))
    wins = F.col("n").isNull() | (F.col("doc_id").eqNullSafe(F.col("b.i")) & (F.col("raw") == F.col("b.raw")))
    rid, rraw, rwins, rn = unused(docs, "_row_id", "_row_raw", "_row_wins", "_row_n")
    rows = keys.groupBy(F.col("doc_id").alias(rid), F.col("raw").alias(rraw)).agg(
        F.max(wins).alias(rwins), F.count(F.lit(1)).alias(rn))
    rows = staged(rows.where(~F.col(rwins) | (F.col(rn) > 1)), "exact-rows")
    raw = F.unhex(F.sha2(text_of(text_col), 256))
    is_row = quoted(id_col).eqNullSafe(F.col(rid)) & (raw == F.col(rraw))
    out = without(docs, rows, quoted(id_col), rid, is_row)
    several = rows.where(rwins)
    if several.isEmpty():
        return out
    one = (docs.join(several, is_row, "left_semi").withColumn(rraw, raw)
           .dropDuplicates([id_col, rraw]).drop(rraw))
    return out.unionByName(one)
