"""The registered queries of the thirteen operators: ``opN_<name>(spark, sf_dir)``.

Each reads its whole table, calls its operator with production parameters and
derives the digest columns of its result from the operator's output.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import WS_RUN, read_table, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(text: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if text:
            SQL[fn.__name__] = text
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def __getattr__(name: str) -> str:
    """TOKENIZERS: the folder of the public tokenizers' files."""
    if name == "TOKENIZERS":
        return os.path.dirname(tokenizer_file("word_bpe_49k.json"))
    raise AttributeError(name)


@_register(sql.LINES)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import apply_bitmaps, keep_bitmaps
    docs = read_table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_register(sql.EXACT)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups
    g = exact_groups(read_table(spark, sf_dir, "documents"))
    return g.select("doc_id", "keep_id", "group_size", "kept",
                    F.lower(F.hex("digest")).alias("text_sha256"))


@_register(sql.SUBSTRINGS)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import dedup_substrings
    kept = dedup_substrings(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_register()
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import cross_entropy_difference, good_documents
    good = good_documents(read_table(spark, sf_dir, "labels"))
    return cross_entropy_difference(read_table(spark, sf_dir, "documents"), good)


@_register()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_fst import decode, encode
    model = tokenizer_file("piece_bpe_32k.model")
    both = decode(encode(read_table(spark, sf_dir, "documents"), model), model)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.xxhash64("ids").alias("ids_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.translate("text", "\u2581", " ")).alias("round_trip"))


@_register(sql.QUALITY)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_policy, fails, quality_ledger
    led = apply_policy(quality_ledger(read_table(spark, sf_dir, "documents")), "full-v1")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      fails("base-v1").alias("base_failed"), "kept", "failed")


@_register(sql.JACCARD)
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_jaccard import jaccard_components
    c = jaccard_components(read_table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@_register(sql.SUFFIXES)
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup_suffixes
    kept = dedup_suffixes(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_register()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import THRESHOLD, toxicity
    p = toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return p.withColumn("toxic", F.col("p_toxic") >= THRESHOLD)


@_register()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


#: op11: documents of more tokens than this are over the limit.
TOKEN_LIMIT = 2048


@_register()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts
    n = token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return n.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the documents op12 reads. A tenth of them, by h = crc32(doc_id), become periodic from some word on."""
    def period(text, h):
        return pd.Series([" ".join(_periodic(t, int(c))) if t is not None else None for t, c in zip(text, h)],
                         dtype=object)
    change = F.pandas_udf(period, "string")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = F.coalesce(h % 10 == 0, F.lit(False))
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.when(hit, change(F.when(hit, text), F.coalesce(h, F.lit(1)))).otherwise(text)
                       .alias("text"))


def _periodic(text: str, h: int) -> list[str]:
    w = [x for x in re.split(WS_RUN, text) if x]
    if not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]


def run_digests(found: DataFrame) -> DataFrame:
    """The columns of op12 from documents with their runs."""
    from .periodic_runs import strongest
    found = found.withColumn("best", strongest())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256)
        .alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))


@_register()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import periodic_runs
    return run_digests(periodic_runs(planted(read_table(spark, sf_dir, "documents"))))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations op13 reads: the first h turns of c - c % 5, then c's own after its first h. (turns, ids)"""
    from .prefix_trie import numbered, turn_rows
    turns = numbered(turn_rows(conversations))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("donor"))
    # the few conversations of a block: who takes which turns of whom, moved by how much
    block = sizes.groupBy("donor").agg(F.collect_list(F.struct("conv_id", "n", "h")).alias("convs"))
    given = F.coalesce(F.get(F.filter("convs", lambda c: c["conv_id"] == F.col("donor")), F.lit(0))["n"],
                       F.lit(0).cast("long"))
    block = block.select("donor", "convs", given.alias("given"), F.explode("convs").alias("c"))

    def takes(conv, low, high, shift):
        return F.struct(conv.alias("to"), low.alias("low"), high.alias("high"), shift.alias("shift"))
    zero = F.lit(0).cast("long")
    c = F.col("c")
    own = takes(c["conv_id"], c["h"], c["n"], F.least(c["h"], F.col("given")) - c["h"])
    lent = F.when(c["conv_id"] == F.col("donor"), F.transform("convs", lambda x: takes(x["conv_id"], zero, x["h"], zero)))
    targets = staged(block.select(c["conv_id"].alias("conv_id"), F.concat(
        F.array(own), F.coalesce(lent, F.slice(F.array(own), 1, 0))).alias("targets")), "targets")
    took = turns.join(targets, "conv_id").select("place", "key", "n_bytes", F.explode(F.filter(
        "targets", lambda x: (x["low"] <= F.col("place")) & (F.col("place") < x["high"]))).alias("x"))
    took = took.select(F.col("x.to").alias("conv_id"), (F.col("place") + F.col("x.shift")).alias("place"), "key", "n_bytes")
    return took, targets.select("conv_id")


@_register(sql.TRIE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie
    return prefix_trie(*rebuilt(read_table(spark, sf_dir, "conversations")))


@_register()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
