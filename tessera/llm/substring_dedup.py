"""Operator 3, substring dedup: De Bruijn compaction over token k-mers.

Words are ``[^\\x20\\x09-\\x0D]+``. A window of ``k`` words (13) is an edge from
its first k-1 to its last k-1 words. An edge repeats if its words also start
in a document with a smaller doc_id; the words it covers go.

1. Anchors. In each window, of its 6-word grams the one with the least hash is
   the window's anchor; equal windows have equal anchors, so only windows whose
   anchor occurs in two documents can repeat. Anchors are a fifth of all places.
2. Edges. The windows with such anchors become edges (hash, document, place).
   Their blocks name the first document that has the edge, and the place in it.
3. Sources. Joined back to the documents, edges name the source documents that
   a chunk of documents needs; these are sent to it, each once per chunk, so a
   source of very many copies is not met by all of them in one task.
4. Compaction and verification. Edges that follow each other both here and in
   the source form nonbranching paths (document, start, length, source, source
   start). A path counts if the source's words at these coordinates are the
   same words; where they are not (the source's edges lie in several rows of
   its doc_id, or 64-bit hashes collide), each of its windows is compared by
   itself. The words of what is verified go, and no others.

Documents meet hashes through ``blocks`` (see there): a passage that a third
of all documents share is sent once per chunk of documents.

Defined results: null and empty text have no words; windows never cross
documents; a null doc_id is larger than all others; rows that repeat a doc_id
are one document, so none of them takes words from another; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import (NULL_ID, PACKED, block_count, chunk_of, chunked, find, joined, per_block,
                     per_chunk, to_blocks, with_replies)
from .common import quoted, unused
from .words import mix64, ngram_hashes, pieces, window_places, word_hashes, word_spans

K = 13
ANCHOR = 6

_TEXT = "doc_id long, text string, n_words long, n_removed long"


def _window_anchors(words: np.ndarray, k: int, m: int) -> np.ndarray:
    """For each place, the hash of the anchor of the window that starts there."""
    g = ngram_hashes(words, m)
    out = g[:len(words) - k + 1].copy()
    for j in range(1, k - m + 1):
        np.minimum(out, g[j:j + len(out)], out=out)
    return mix64(out, 14)      # least hashes are small numbers: mixed again, they spread evenly over the blocks


def _windows(table: pa.Table, k: int, m: int):
    """Per piece of a chunk: (row, doc_id, place, anchor hash, edge hash) of all windows."""
    docs = table["doc_id"].to_numpy()
    for at, to, data, offs in pieces(table["t"].combine_chunks()):
        s, e, first = word_spans(data, offs)
        w = word_hashes(data, s, e)
        p = window_places(first, k)
        if len(p):
            row = np.repeat(np.arange(at, to), np.maximum(np.diff(first) - k + 1, 0))
            yield row, docs[row], p - first[row - at], _window_anchors(w, k, m)[p], ngram_hashes(w, k)[p]


def _first_of_each(h: np.ndarray, doc: np.ndarray, pos: np.ndarray):
    """Per distinct hash: the hash, first doc, first place, whether in two documents."""
    order = np.lexsort((pos, doc, h))
    h, doc, pos = h[order], doc[order], pos[order]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    end = np.concatenate([at[1:], [len(h)]]).astype(np.int64) if len(h) else at
    many = doc[at] != doc[end - 1]
    return h[at], doc[at], pos[at], many


def _gather(parts: list, dtypes: list) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, d) for d in dtypes]


def _send_anchors(k: int, m: int, n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        parts = []
        for _, doc, _, anchor, _ in _windows(table, k, m):
            keep = np.ones(len(doc), bool)      # neighbours share their anchor most of the time
            keep[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            parts.append((anchor[keep], doc[keep]))
        a, doc = _gather(parts, [np.uint64, np.int64])
        h, _, _, many = _first_of_each(a, doc, doc)
        return to_blocks(table["chunk"][0].as_py(), n_blocks, h, [many.astype(np.uint8)])
    return run


def _shared_anchors(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
    n = np.diff(np.concatenate([first, [len(run_of)]]))
    shared = (n > 1) | (np.maximum.reduceat(cols[0], first) > 0)
    return shared[run_of], []


def _send_edges(k: int, m: int, n_blocks: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_blocks(0, n_blocks, np.zeros(0, np.uint64), [])
        shared, = joined(replies, [])
        parts = []
        for _, doc, pos, anchor, edge in _windows(table, k, m):
            may, _ = find(anchor, shared)
            parts.append((edge[may], doc[may], pos[may]))
        h, doc, pos, many = _first_of_each(*_gather(parts, [np.uint64, np.int64, np.int64]))
        return to_blocks(table["chunk"][0].as_py(), n_blocks, h,
                         [doc, pos.astype(np.uint32), many.astype(np.uint8)])
    return run


def _sources(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
    doc, pos, many = cols
    end = np.concatenate([first[1:], [len(run_of)]]) - 1
    shared = (doc[first] != doc[end]) | (np.maximum.reduceat(many, first) > 0)
    return shared[run_of], [doc[first][run_of], pos[first][run_of]]


def _later(table: pa.Table, edge: np.ndarray, source: np.ndarray, source_at: np.ndarray, k: int, m: int):
    """Per piece of a chunk: (row, place, source, source place) of the windows that an earlier document has."""
    for row, doc, pos, _, h in _windows(table, k, m) if len(edge) else ():
        hit, at = find(h, edge)
        go = np.flatnonzero(hit & (source[at] < doc))
        if len(go):
            yield row[go], pos[go], source[at[go]], source_at[at[go]].astype(np.int64)


def _ask_sources(k: int, m: int):
    """The documents that a chunk needs for its paths, each once."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        edge, source, source_at = joined(replies, [np.int64, np.uint32])
        need = [np.unique(src) for _, _, src, _ in _later(table, edge, source, source_at, k, m)]
        need = np.unique(np.concatenate([*need, np.zeros(0, np.int64)]))
        ask = table["chunk"][0].as_py() if table.num_rows else 0
        return pa.table({"source": pa.array(need), "ask": pa.array(np.full(len(need), ask, np.int64))})
    return run


def _send_sources(table: pa.Table, asked: pa.Table) -> pa.Table:
    """The texts asked for, addressed to the chunks that ask."""
    rows: dict[int, list[int]] = {}
    wanted = set(asked["source"].to_pylist())
    for i, d in enumerate(table["doc_id"].to_pylist()):
        if d in wanted:
            rows.setdefault(d, []).append(i)
    out = [(ask, d, i) for d, ask in zip(asked["source"].to_pylist(), asked["ask"].to_pylist())
           for i in rows.get(d, ())]
    ask, d, i = zip(*out) if out else ((), (), ())
    return pa.table({"chunk": pa.array(ask, pa.int64()), "source": pa.array(d, pa.int64()),
                     "source_text": table["t"].take(pa.array(i, pa.int64())).cast(pa.string())})


def _cut(k: int, m: int, as_is: bool):
    """Compacts later edges to paths, verifies these in their sources, cuts their words."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        is_text = replies["source"].is_valid().to_numpy() if replies.num_rows else np.zeros(0, bool)
        edge, source, source_at = joined(replies.filter(pa.array(~is_text)), [np.int64, np.uint32])
        texts: dict[int, list[list[bytes]]] = {}
        sent = replies.filter(pa.array(is_text))
        for d, t in zip(sent["source"].to_pylist(), sent["source_text"].to_pylist()):
            texts.setdefault(d, []).append(t.encode().split())
        spans: dict[int, list[tuple[int, int, int, int]]] = {}
        for r, p, s, q in _later(table, edge, source, source_at, k, m):
            # a path goes on while the next edge follows both here and in the source
            cut = np.flatnonzero((r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1) | (s[1:] != s[:-1])
                                 | (q[1:] != q[:-1] + 1)) + 1
            begin = np.concatenate([[0], cut])
            length = np.diff(np.concatenate([begin, [len(r)]])) + k - 1
            for row, *path in zip(*(x[begin].tolist() for x in (r, p, s, q)), length.tolist()):
                spans.setdefault(row, []).append(tuple(path))
        kept, total, gone = [], [], []
        for i, t in enumerate(table["t"].to_pylist()):
            words = t.encode().split()
            total.append(len(words))
            if i in spans:
                keep = np.ones(len(words), bool)
                for p, s, q, n in spans[i]:
                    rows = texts.get(s, ())
                    if any(w[q:q + n] == words[p:p + n] for w in rows):
                        keep[p:p + n] = False
                        continue
                    # the source has its edges in several rows, or a hash collides: window by window
                    for j in range(n - k + 1):
                        if any(w[q + j:q + j + k] == words[p + j:p + j + k] for w in rows):
                            keep[p + j:p + j + k] = False
                words = [w for w, y in zip(words, keep.tolist()) if y]
            gone.append(total[-1] - len(words))
            kept.append(t if as_is and not gone[-1] else b" ".join(words).decode())
        ids = table["doc_id"].to_numpy() if table.num_rows else np.zeros(0, np.int64)
        out = pa.table({"doc_id": pa.array(ids, mask=ids == NULL_ID), "text": pa.array(kept, pa.string()),
                        "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64())})
        return out.append_column("extra", table["extra"]) if "extra" in table.column_names else out
    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     k: int = K, anchor: int = ANCHOR, carry: Sequence[str] = (), as_is: bool = False) -> DataFrame:
    """(doc_id, text, n_words, n_removed) per document: the kept words, joined by one space.

    Columns named in ``carry`` come along as the struct ``extra``. With
    ``as_is`` a document that loses nothing keeps its text as it stands, and
    ``has_text`` says whether it had one.
    """
    n = block_count(docs, text_col)
    has, = unused(docs, "has_text")
    if as_is:
        docs = docs.withColumn(has, quoted(text_col).isNotNull())
        carry = [*carry, has]
    t = chunked(docs, n, id_col, text_col, carry)
    anchors = per_block(per_chunk(t, _send_anchors(k, anchor, n), PACKED), [np.uint8], _shared_anchors)
    edges = per_block(with_replies(t, anchors, _send_edges(k, anchor, n), PACKED),
                      [np.int64, np.uint32, np.uint8], _sources)
    asked = with_replies(t, edges, _ask_sources(k, anchor), "source long, ask long")
    texts = with_replies(t, asked.withColumn("chunk", chunk_of(F.col("source"), n)), _send_sources,
                         "chunk long, source long, source_text string")
    replies = (edges.select("chunk", "n", "body").withColumn("source", F.lit(None).cast("long"))
               .withColumn("source_text", F.lit(None).cast("string"))
               .unionByName(texts.withColumn("n", F.lit(None).cast("long")).withColumn("body", F.lit(None).cast("binary"))))
    schema = StructType.fromDDL(_TEXT)
    if carry:
        schema = schema.add("extra", t.schema["extra"].dataType)
    out = with_replies(t, replies, _cut(k, anchor, as_is), schema)
    return out.withColumn("has_text", F.col("extra")[has]) if as_is else out
