"""Operator 6, quality rules: a rule bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one long whose bit r says that rule r failed. A policy is a named,
versioned bitmask; applying it, or any other version, is one bitwise AND over
the ledger and reads no text. Ablations (what would each rule's removal
keep?) come from the counts of the distinct masks, of which there are at most
2 ** len(RULES), whatever the corpus size.

All measurements are linear in the text. Repeated five-word windows are found
by sorting the 64-bit window hashes of one document and comparing neighbours;
documents without a repeated hash skip the sort.

Defined results: null or empty text has no words and one empty line and fails
``few_words``; repeated rows are judged each alike; an empty table gives an
empty ledger. No shuffle and no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, WS_RUN, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule name -> condition that fails it, over the ledger's measurements. Bit r is the r-th rule.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeat_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
    "digits": "10 * n_digits > 3 * word_chars",
}


def mask_of(*rules: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


#: Versioned policies. A published version never changes; a change is a new version.
POLICIES: dict[str, int] = {
    "base-v1": mask_of("few_words", "repeat_words"),
    "full-v1": mask_of(*RULES),
}


def _removed(c: str, chars: str) -> Column:
    return F.char_length(c) - F.char_length(F.translate(c, chars, ""))


def _covered(starts: str) -> Column:
    """Words covered by windows that start at the given sorted places."""
    gaps = F.zip_with(F.col(starts), F.slice(F.col(starts), 2, F.greatest(F.size(starts), F.lit(1))),
                      lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def quality_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, measurements (long), ``failed`` (long bitmask over RULES)."""
    t = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    t = t.withColumn("core", F.btrim("t", F.lit(WS)))
    empty = F.array().cast("array<string>")
    t = t.select("doc_id", "t",
                 F.when(F.col("core") == "", empty).otherwise(F.split("core", WS_RUN, -1)).alias("words"),
                 F.split("t", "\n", -1).alias("lines"))
    t = t.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate("t", WS, "")).cast("long").alias("word_chars"),
        _removed("t", SYMBOLS).cast("long").alias("n_symbols"),
        _removed("t", "0123456789").cast("long").alias("n_digits"),
        F.size("lines").cast("long").alias("n_lines"),
        F.filter("lines", lambda x: F.btrim(x, F.lit(WS)) != "").alias("full_lines"),
        F.when(F.size("words") >= WINDOW,
               F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                           lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    t = t.withColumn("n_dup_lines", (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long"))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    t = t.withColumn("s", F.when(repeats, F.array_sort(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    # neighbours in hash order with the same hash: both windows repeat
    pairs = F.zip_with(F.col("s"), F.slice(F.col("s"), 2, F.size("s")),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    t = t.withColumn("at", F.array_sort(F.array_distinct(F.flatten(
        F.filter(pairs, lambda p: p.isNotNull())))))
    t = t.withColumn("n_repeat_words", F.coalesce(_covered("at"), F.lit(0)).cast("long"))
    m = t.select("doc_id", "n_words", "word_chars", "n_symbols", "n_digits", "n_lines",
                 "n_dup_lines", "n_repeat_words")
    failed = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return m.withColumn("failed", failed)


def fails(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) != 0


def apply_policy(ledger: DataFrame, policy: str, out: str = "kept") -> DataFrame:
    """The ledger with the verdict of one policy version; no text is read."""
    return ledger.withColumn(out, ~fails(policy))


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents failing it, failing it alone, kept without it.

    One aggregate over the masks (at most 2 ** rules rows), then bitwise
    arithmetic on that small table.
    """
    p = POLICIES[policy]
    masks = (ledger.groupBy(F.col("failed").bitwiseAND(F.lit(p)).alias("m"))
             .agg(F.count(F.lit(1)).alias("n"), F.bit_or("failed").alias("any_failed")))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << b).cast("long").alias("bit"))
                                for b, r in enumerate(RULES) if p >> b & 1]))
    each = masks.select("m", "n", rules.alias("r")).select("m", "n", "r.*")
    has = F.col("m").bitwiseAND(F.col("bit")) != 0
    rest = F.col("m").bitwiseAND(F.bitwise_not("bit")) == 0
    return each.groupBy("rule").agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("n_kept_without"))
