"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it
returns is written as Parquet to the shared folder and read again as the next
stage's docs. All but the last return the columns of documents. Part of the
``tessera.llm`` subpackage.

Empty tables pass through; a null text counts as empty; exact and near copies
are dropped by row, whatever their doc_ids; columns that documents may have
beyond its own travel along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table, staged
from tessera.llm.exact_dedup import drop_exact_copies
from tessera.llm.ngram_jaccard import drop_near_copies
from tessera.llm.packing import pack
from tessera.llm.queries import tokenizer_file
from tessera.llm.substring_dedup import dedup_substrings
from tessera.llm.toxicity import THRESHOLD, toxicity
from tessera.session import prepare_session


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    prepare_session(spark)
    p = toxicity(docs, read_table(spark, sf_dir, "labels"), carry=True)
    return p.where(F.col("p_toxic") < THRESHOLD).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    prepare_session(spark)
    return drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one document stays."""
    prepare_session(spark)
    return drop_near_copies(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; every document stays, with what is left.

    A document that loses nothing keeps its row as it is; of the others the
    words left are joined by one space and n_chars is taken anew.
    """
    prepare_session(spark)
    cut = dedup_substrings(docs, carry=[c for c in docs.columns if c != "text"], as_is=True)
    lost = F.col("n_removed") > 0

    def column(c):
        if c == "text":
            return F.when(lost | F.col("has_text"), F.col("text"))
        own = F.col("extra")[c]
        if c == "n_chars":
            return F.when(lost, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(own)
        return own
    return cut.select(*[column(c).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    prepare_session(spark)
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near),
    ("substring_dedup", drop_passages),
    ("packing", pack_sequences),
]

#: No SQL for a classifier or a tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    prepare_session(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
