"""Hash blocks: find which hashed features of a corpus occur elsewhere, cheaply.

Two operators ask the same question of very many features (token k-mers,
n-grams): which of a document's features occur in other documents too, and
where first? A Spark row for each feature would be most of the cost. Here the
documents are dealt into *chunks* (a few MB of text each, by a hash of
doc_id); a chunk sorts its features' hashes and drops repeats, so that even a
feature of a third of all documents is sent once per chunk, and sends each
*block* (an equal range of hash values) one packed row. A block merges what
its chunks sent and sends each chunk one packed row with those of the chunk's
hashes that matter. All of it is ordinary Spark grouping (``applyInArrow``);
chunk and block counts follow the input size, so the memory of a task does
not grow with the input.

Packed columns are byte planes (all lowest bytes, then all next bytes, ...) of
sorted hash differences and integers, compressed with an entropy coder: high
planes are nearly constant and vanish, small counts take a few bits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, text_of, total_chars

PACKED = "block long, chunk long, n long, body binary"
#: A null doc_id stands after all others.
NULL_ID = (1 << 63) - 1
CHUNK_CHARS = 4_000_000


def block_count(docs: DataFrame, text_col: str) -> int:
    """Chunks and blocks for this input: by its size, and at least the shuffle width."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-total_chars(docs, text_col) // CHUNK_CHARS))


def chunk_of(doc_id, n: int):
    return F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("long")


def chunked(docs: DataFrame, n: int, id_col: str, text_col: str, carry: Sequence[str] = (),
            by_row: bool = False) -> DataFrame:
    """(chunk, doc_id, row, t): the documents with their chunk; null ids as NULL_ID.

    ``row`` is a hash of the text: rows of one doc_id differ by it. (A row's
    place in its chunk would not do: a shuffle may deliver rows in any order.)
    ``carry`` names columns that travel along as the struct ``extra``. Rows of
    one doc_id share a chunk, unless ``by_row`` deals them by doc_id and text.
    """
    extra = [F.struct(*[quoted(c).alias(c) for c in carry]).alias("extra")] if carry else []
    t = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                    text_of(text_col).alias("t"), *extra)
    row = F.xxhash64("t")
    # any number of rows may lack an id: these are dealt by their text
    by_id = chunk_of(F.when(F.col("doc_id") == NULL_ID, row).otherwise(F.col("doc_id")), n)
    return t.select((chunk_of(F.xxhash64("doc_id", row), n) if by_row else by_id).alias("chunk"), "doc_id",
                    row.alias("row"), "t", *(["extra"] if carry else []))


def planes(a: np.ndarray) -> bytes:
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(body: memoryview, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(body, np.uint8, n * size).reshape(size, n).T.copy().view(dtype).reshape(n)


def packed(body_of: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """Rows (block, chunk, n, body) as a table."""
    b, c, n, body = zip(*body_of) if body_of else ((), (), (), ())
    return pa.table({"block": pa.array(b, pa.int64()), "chunk": pa.array(c, pa.int64()),
                     "n": pa.array(n, pa.int64()), "body": pa.array(body, pa.binary())})


def codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _body(h: np.ndarray, cols: list[np.ndarray]) -> bytes:
    d = h.copy()
    d[1:] -= h[:-1]
    return codec().compress(b"".join([planes(d), *map(planes, cols)]), asbytes=True)


def to_blocks(chunk: int, n_blocks: int, h: np.ndarray, cols: list[np.ndarray]) -> pa.Table:
    """Sorted hashes of one chunk, with columns, packed per block.

    Blocks are equal ranges, so the hashes must be spread over all 64 bits.
    """
    block = block_of(h, n_blocks)
    cuts = np.flatnonzero(np.diff(block)) + 1
    edges = [0, *cuts.tolist(), len(h)] if len(h) else []
    return packed([(int(block[a]), chunk, b - a, _body(h[a:b], [c[a:b] for c in cols]))
                   for a, b in zip(edges, edges[1:])])


def unpack(table: pa.Table, dtypes: list) -> list[tuple[np.ndarray, ...]]:
    """Per row: the hashes and the columns."""
    out, unzip = [], codec()
    size = 8 + sum(np.dtype(d).itemsize for d in dtypes)
    for n, body in zip(table["n"].to_pylist(), table["body"].to_pylist()):
        view, at = memoryview(unzip.decompress(body, decompressed_size=n * size, asbytes=True)), 8 * n
        cols = [np.cumsum(unplanes(view, n, np.uint64), dtype=np.uint64)]
        for d in dtypes:
            cols.append(unplanes(view[at:], n, d))
            at += n * np.dtype(d).itemsize
        out.append(tuple(cols))
    return out


def joined(table: pa.Table, dtypes: list) -> tuple[np.ndarray, ...]:
    """All rows one after another, sorted by hash (blocks hold disjoint ranges)."""
    rows = unpack(table, dtypes)
    if not rows:
        return tuple(np.zeros(0, d) for d in (np.uint64, *dtypes))
    rows.sort(key=lambda r: r[0][0])
    return tuple(np.concatenate(c) for c in zip(*rows))


def block_of(h: np.ndarray, n_blocks: int) -> np.ndarray:
    """The block of each hash: blocks are equal ranges."""
    return ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)


def marked(which: np.ndarray, cols: list[np.ndarray]) -> tuple[int, bytes]:
    """A reply by place: a bit for each entry sent, and then the columns of those marked."""
    body = np.packbits(which).tobytes() + b"".join(planes(c[which]) for c in cols)
    return int(which.sum()), codec().compress(body, asbytes=True)


def unmarked(body: bytes, sent: int, n: int, dtypes: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of ``sent`` entries the places marked, and their columns."""
    at = -(-sent // 8)
    size = at + n * sum(np.dtype(d).itemsize for d in dtypes)
    raw = memoryview(codec().decompress(body, decompressed_size=size, asbytes=True))
    places = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, at), count=sent))
    if len(places) != n:
        raise ValueError("a reply does not fit what the chunk sent")
    cols = []
    for d in dtypes:
        cols.append(unplanes(raw[at:], n, d))
        at += n * np.dtype(d).itemsize
    return places, cols


def placed(h: np.ndarray, n_blocks: int, replies: pa.Table, dtypes: list) -> tuple[np.ndarray, ...]:
    """Replies by place to the sorted hashes ``h`` that a chunk sent: the places in ``h`` that matter, ascending, and their columns."""
    block, parts = block_of(h, n_blocks), []
    for b, n, body in sorted(zip(*(replies[c].to_pylist() for c in ("block", "n", "body")))):
        lo, hi = np.searchsorted(block, np.array([b, b + 1], np.uint64)).tolist()
        at, cols = unmarked(body, hi - lo, n, dtypes)
        parts.append((at + lo, *cols))
    if not parts:
        return tuple(np.zeros(0, d) for d in (np.int64, *dtypes))
    return tuple(np.concatenate(c) for c in zip(*parts))


def merge_in_block(dtypes: list, merge, by_place: bool = False):
    """A block's task: ``merge(h, cols) -> (which of the entries matter, columns to send back)``
    sees all entries sorted by hash and then by the columns in turn; what
    matters goes back to the chunk it came from, with its hashes or, ``by_place``, by
    its places among what the chunk sent (whose hashes must be distinct).
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rows = unpack(table, dtypes)
        sent = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        h, *cols = (np.concatenate(c) for c in zip(*rows))
        order = np.lexsort((*cols[::-1], h))
        h, cols, sent = h[order], [c[order] for c in cols], sent[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        run_of = np.cumsum(new) - 1
        matters, back = merge(np.flatnonzero(new), run_of, cols)
        chunk, block = table["chunk"].to_pylist(), table["block"].to_pylist()
        if by_place:
            by = np.argsort(sent, kind="stable")      # keeps the hash order within a sender
            which, back = matters[by], [b[by] for b in back]
            ends = np.cumsum([len(r[0]) for r in rows]).tolist()
            return packed([(block[i], chunk[i], *marked(which[a:b], [c[a:b] for c in back]))
                           for i, (a, b) in enumerate(zip([0, *ends], ends)) if which[a:b].any()])
        h, sent, back = h[matters], sent[matters], [b[matters] for b in back]
        by = np.argsort(sent, kind="stable")          # keeps the hash order within a sender
        h, sent, back = h[by], sent[by], [b[by] for b in back]
        edges = np.searchsorted(sent, np.arange(len(rows) + 1))
        return packed([(block[i], chunk[i], int(b - a), _body(h[a:b], [c[a:b] for c in back]))
                       for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a])
    return run


def find(h: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``h`` is in the sorted ``among``, and where."""
    if not len(among):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(among, h), len(among) - 1)
    return among[at] == h, at


def per_chunk(t: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(table)`` for each chunk of documents."""
    return t.groupBy("chunk").applyInArrow(fn, schema)


def with_replies(t: DataFrame, replies: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(documents, replies)`` for each chunk of documents (co-grouped by chunk)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.combine_chunks(), right.combine_chunks())
    return t.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def per_block(entries: DataFrame, dtypes: list, merge, by_place: bool = False) -> DataFrame:
    return entries.groupBy("block").applyInArrow(merge_in_block(dtypes, merge, by_place), PACKED)
