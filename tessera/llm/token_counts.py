"""Operator 11, token counts: overlap resynchronisation for huge documents.

Texts of up to ``huge`` bytes are counted where they are read. They are cut at
ASCII white space, which this kind of tokenizer drops and joins nothing
across (``packing.WordEncoder`` refuses one that differs), and each distinct
word is given to the tokenizer once per worker.

A longer text is cut into chunks of ``chunk`` code points, each with the first
``overlap`` of the next, and every chunk is a row of its own, so one document
is encoded by many tasks. A chunk gives its number of tokens and, for the
overlap on each side, the tokens' offsets in the document. Where chunk j
begins, chunk j - 1 and chunk j have both encoded the same overlap. They are
spliced there at the first *common stable boundary* p:

* a gap: one token ends before p and the next begins at or after it, so that
  all between is white space, which the pre-tokenizer's pattern never takes
  into a token, no special token holds, and normalisation composes with
  nothing. What stands left of a gap is encoded alike whatever follows it, what stands
  right of it alike whatever comes before: the boundary is proven;
* common: the tokens on both sides of the gap are the same, id and offsets, in
  both chunks.

With A_j(p) the tokens of chunk j that end by p, the document has
A_last(end) + sum over its seams of A_{j-1}(p_j) - A_j(p_j) tokens: a sum that
Spark aggregates, without bringing a document's chunks together. Documents
with a seam without such a boundary are done again with chunks and overlaps
``WIDEN`` times as long, until all align; a text in one chunk has no seam. So
no case is dropped, and the work of a text without any white space is
bounded by a constant number of times its length.

Defined results: null and empty texts have 0 bytes and 0 tokens; special
strings in a text are its special tokens, as is the library's default; a null
doc_id is carried through; repeated rows are counted row by row; an empty table
gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of
from .packing import word_encoder

#: Bytes beyond which a text is encoded in chunks.
HUGE = 1 << 16
CHUNK = 1 << 15
OVERLAP = 512
#: Chunks and overlaps grow by this factor where alignment fails.
WIDEN = 4
#: Bytes of text encoded at once.
BATCH = 1 << 20

_COUNTED = "doc_id long, n_bytes long, n_tokens long"
_CHUNKS = "key string, no long, last boolean, start long, next long, piece string"
_ZONE = "array<struct<s:long,e:long,id:long>>"
_ENCODED = (f"key string, no long, last boolean, n_tokens long, head {_ZONE}, tail {_ZONE}, tail_before long")


def _count_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(1).cast(pa.large_binary()).to_pylist()
            counts: list[np.ndarray] = []
            at = 0
            while at < len(data):
                to, held = at, 0
                while to < len(data) and (to == at or held + len(data[to]) <= BATCH):
                    held += len(data[to])
                    to += 1
                counts.append(np.diff(word_encoder(path).encode(data[at:to])[1]))
                at = to
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(d) for d in data], pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Rows of chunks, the rows of one text in a batch or more of bounded size."""
    names = ["key", "no", "last", "start", "next", "piece"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows, held = [], 0
                for no, start in enumerate(range(0, max(len(text), 1), chunk)):
                    last = start + chunk >= len(text)
                    piece = text[start:start + chunk + overlap]
                    rows.append((key, no, last, start, start + chunk, piece))
                    held += len(piece)
                    if held > BATCH:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)
    return run


def _encode_chunks(path: str, overlap: int):
    def zone(tokens: np.ndarray, a: int, b: int) -> list[dict]:
        """Tokens that lie in [a, b), as offsets in the document."""
        some = tokens[(tokens[:, 0] >= a) & (tokens[:, 1] <= b)]
        return [{"s": s, "e": e, "id": i} for s, e, i in some.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                key, no, last, start, nxt, piece = (c[r].as_py() for c in batch.columns)
                got = word_encoder(path).tokenizer.encode_batch([piece], add_special_tokens=False)[0]
                tokens = np.zeros((len(got.ids), 3), np.int64)
                if len(tokens):
                    tokens[:, :2] = got.offsets
                    tokens[:, :2] += start
                    tokens[:, 2] = got.ids
                tail = [] if last else zone(tokens, nxt, nxt + overlap)
                before = int(np.searchsorted(tokens[:, 0], tail[0]["s"])) if tail else 0
                rows.append({"key": key, "no": no, "last": last, "n_tokens": len(tokens),
                             "head": zone(tokens, start, start + overlap) if no else [], "tail": tail,
                             "tail_before": before})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())
    return run


def _arrow_schema() -> pa.Schema:
    zone = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("id", pa.int64())]))
    return pa.schema([("key", pa.string()), ("no", pa.int64()), ("last", pa.bool_()), ("n_tokens", pa.int64()),
                      ("head", zone), ("tail", zone), ("tail_before", pa.int64())])


def _gaps(zone: str):
    """Of a zone: (tokens up to and with the one before the gap, that token, the one after)."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(zone) - 1, F.lit(1))),
                        lambda i: F.struct(i.cast("long").alias("n"), F.get(zone, i - 1).alias("a"),
                                           F.get(zone, i).alias("b")))
    return F.filter(pairs, lambda g: g["a"]["e"] < g["b"]["s"])


def splices(encoded: DataFrame) -> DataFrame:
    """One row per seam: key, ``change`` = A_{j-1}(p_j) - A_j(p_j), null where no boundary is common."""
    left = encoded.where(~F.col("last")).select(
        F.col("key").alias("k"), (F.col("no") + 1).alias("seam"), _gaps("tail").alias("gaps"), "tail_before")
    right = encoded.where(F.col("no") > 0).select("key", "no", _gaps("head").alias("own"))
    both = right.join(left, (F.col("key") == F.col("k")) & (F.col("no") == F.col("seam")))
    # the head begins with its chunk, so its place in the head is its number in the chunk
    met = F.transform("gaps", lambda g: F.struct(
        g["n"].alias("n"), F.get(F.filter("own", lambda o: (o["a"] == g["a"]) & (o["b"] == g["b"])), F.lit(0))["n"]
        .alias("m")))
    first = F.get(F.filter(met, lambda x: x["m"].isNotNull()), F.lit(0))
    return both.select("key", (F.col("tail_before") + first["n"] - first["m"]).alias("change"))


def count_huge(texts: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_tokens) of distinct texts (key, t), by chunks, overlaps and splices."""
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = None
    left = texts
    while True:
        chunks = left.mapInArrow(_cut(chunk, overlap), _CHUNKS).repartition(width, "key", "no")
        encoded = staged(chunks.mapInArrow(_encode_chunks(tokenizer, overlap), _ENCODED).dropDuplicates(["key", "no"]),
                         "chunks")
        seams = staged(splices(encoded).unionByName(
            encoded.where("last").select("key", F.col("n_tokens").alias("change"))), "seams")
        per = seams.groupBy("key").agg(F.sum("change").alias("n_tokens"),
                                       F.max(F.col("change").isNull()).alias("open"))
        counted = per.where("not open").select("key", "n_tokens")
        done = counted if done is None else done.unionByName(counted)
        still = per.where("open").select("key")
        if still.isEmpty():
            return done
        left = left.join(still, "key", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens."""
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    size = F.octet_length("t")
    short = t.where(size <= huge).mapInArrow(_count_words(tokenizer), _COUNTED)
    long = t.where(size > huge).withColumn("key", F.sha2("t", 256))
    counted = count_huge(long.select("key", "t"), tokenizer, chunk, overlap)
    long = long.select("doc_id", size.cast("long").alias("n_bytes"), "key").join(counted, "key", "left")
    return short.unionByName(long.select("doc_id", "n_bytes", "n_tokens"))
