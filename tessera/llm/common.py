"""Helpers shared by the corpus operators.

Conventions of every operator here:

* A null text counts as an empty text.
* ``doc_id`` names the document. Rows that repeat a doc_id *and* its text get
  the same result each; a null doc_id is one more id, larger than all others.
* Only the columns an operator reads are selected from its input, so extra
  columns, whatever their names, never clash with its own.
* Intermediate tables are written as Parquet to the shared folder that
  ``spark.checkpoint.dir`` names, so a lost executor costs no recomputation
  of what was staged before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of every word rule here: [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"
WS_RUN = "[\\x20\\x09-\\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, each with underscores before it until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def id_after_all(name: str = "doc_id") -> list[Column]:
    """Sort columns under which a null id comes last."""
    return [F.col(name).isNull(), F.col(name)]


def staged(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a reliable copy that every executor can read. The
    files are removed by ``unstage``, or when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*tables: DataFrame | None) -> None:
    """Delete staged tables that no later plan reads."""
    for t in tables:
        path = getattr(t, "_staged_path", None)
        if path:
            jvm = t.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Words of 64 bits in which ``without`` marks keys: what is broadcast has so many rows at most.
MARK_WORDS = 1 << 18


def without(docs: DataFrame, gone: DataFrame, own: Column, key: str, on: Column) -> DataFrame:
    """``docs`` less the rows for which ``on`` finds a row in ``gone``, exactly.

    ``on`` must imply that ``own`` equals ``gone``'s column ``key``. Hashes of the keys are marked in a
    bitmap of bounded size, which is broadcast; only rows whose bit is set are shuffled, with their
    texts, for the join that decides. Reads ``docs`` twice.
    """
    word, bits = unused(docs, "_mark_word", "_mark_bits")

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(MARK_WORDS))

    def bit(c: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(c), 58).cast("int")
    bit_of = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(key)))
    marks = gone.groupBy(place(F.col(key)).alias(word)).agg(F.bit_or(bit_of).alias(bits))
    rows = docs.join(F.broadcast(marks), place(own) == F.col(word), "left")
    hit = F.getbit(F.coalesce(bits, F.lit(0).cast("long")), bit(own)) == 1
    asked = rows.where(hit).drop(word, bits)
    return rows.where(~hit).drop(word, bits).unionByName(asked.join(gone, on, "left_anti"))


def total_chars(docs: DataFrame, text: str = "text") -> int:
    """Code points in all texts: one narrow aggregate, used to size blocks."""
    return int(docs.agg(F.sum(F.char_length(F.col(text)))).first()[0] or 0)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Keep Arrow batches of whole texts small: a batch is held by a worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
