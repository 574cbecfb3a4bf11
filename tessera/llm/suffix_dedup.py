"""Operator 8, suffix-array dedup: threshold-bounded backward extension on a sparse BWT.

A byte goes if a string of ``length`` bytes (200) that covers it also starts
anywhere else. The suffix array of all bytes is never built; the transform is
taken at anchored suffixes, block by block:

1. Anchors. Of the 40-byte grams of a window of 200 bytes, the one with the
   least hash is its anchor, so equal windows have equal anchors at equal
   places. Blocks of anchor hashes (``blocks``) tell which occur twice.
2. Contexts. Around each such anchor, the bytes that its windows span go to
   the anchor's block; equal contexts are sent once per chunk of documents.
3. Transform. A block sorts its anchored suffixes (a sparse suffix array, with
   common prefixes of neighbours). Breadth first, every interval is extended
   backwards by one byte: the bytes before the suffixes (the transform's
   column) split it, stably, into smaller intervals, whose neighbours' common
   prefixes are range minima, one longer with each level. Level o thus holds
   the strings that begin o bytes before their anchor; neighbours that share
   ``length`` bytes repeat. It ends at the last level at which an anchor can
   still lie in the window. All windows of an anchor overlap, so its first and
   its last repeated window bound the bytes that go.
4. The documents get their intervals back and lose the bytes.

An anchor that occurs more often than ``HOT`` (a passage that very many
documents hold) is not gathered in one block: its windows go out one by one as
hashes of 128 bits, each once per chunk, and are counted in the blocks of
their own hashes. That is the same test, for any number of occurrences.

Defined results: null and empty text have no bytes; matches never cross
documents; all copies go, the first included; rows that repeat a doc_id are
texts of their own, so two equal rows of 200 bytes or more take each other's
bytes; null ids are carried through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import (NULL_ID, PACKED, _body, block_count, chunked, find, joined, merge_in_block,
                     per_block, per_chunk, planes, to_blocks, unplanes, with_replies)
from .words import byte_sums, gram_hashes, mix64, pieces, running_sums, span_hashes, window_places

LENGTH = 200
ANCHOR = 40
#: Random 64-bit stand-ins of the byte values (fixed by their seed), for the second hash of a window.
_STAND_IN = mix64(np.arange(256, dtype=np.uint64), 16)
#: Occurrences from which an anchor's windows are matched by their own hashes.
HOT = 2000
_PIECE = 1 << 19

_CONTEXTS, _WINDOWS = 0, 1
_KINDS = PACKED + ", kind int"
_TEXT = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"


def _anchor_runs(data: np.ndarray, offs: np.ndarray, length: int, m: int):
    """Per anchor in use: first and last window start, the anchor's place, its hash; and the byte sums."""
    s = window_places(offs, length)
    sums = byte_sums(data)
    if not len(s):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), sums
    g = gram_hashes(sums, m, seed=m)
    low = np.uint64((1 << int(len(g)).bit_length()) - 1)
    key = (g & ~low) | np.arange(len(g), dtype=np.uint64)     # least hash, leftmost on ties
    width, span = length - m + 1, 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:span - width], key[width - span:])
    p = (key[s] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    last = np.concatenate([first[1:], [len(p)]]) - 1
    # least hashes are small numbers: mixed again, they spread evenly over the blocks
    return s[first], s[last], p[first], mix64(g[p[first]], 14), sums


def _context_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray, p: np.ndarray, length: int) -> np.ndarray:
    return mix64(span_hashes(sums, a, b + length, seed=11) + (p - a).astype(np.uint64), 12)


def _window_hash(sums: np.ndarray, byte_twice: np.ndarray, s: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window: two hashes, over its bytes by two polynomials."""
    return span_hashes(sums, s, s + length, seed=13), span_hashes(byte_twice, s, s + length, seed=15)


def _second_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of another polynomial: of each byte's random stand-in instead of the byte."""
    return running_sums(_STAND_IN[data])


def _distinct(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (h, c), sorted, and how often each occurs."""
    order = np.lexsort((c, h))
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
    return h[first], c[first], np.diff(np.concatenate([first, [len(h)]]))


def _send_anchors(length: int, m: int, n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        h = [_anchor_runs(d, o, length, m)[3] for _, _, d, o in pieces(table["t"].combine_chunks(), _PIECE)]
        h, n = np.unique(np.concatenate([*h, np.zeros(0, np.uint64)]), return_counts=True)
        return to_blocks(table["chunk"][0].as_py(), n_blocks, h, [n.astype(np.uint32)])
    return run


def _repeated(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
    total = np.add.reduceat(cols[0].astype(np.int64), first)
    return (total > 1)[run_of], [np.minimum(total, (1 << 32) - 1).astype(np.uint32)[run_of]]


def _with_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.append_column("kind", pa.array(np.full(table.num_rows, kind, np.int32)))


def _send_contexts(length: int, m: int, n_blocks: int, hot: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py() if table.num_rows else 0
        shared, total = joined(replies, [np.uint32])
        parts: list[tuple[np.ndarray, ...]] = []
        held: list[np.ndarray] = []
        windows = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for _, _, data, offs in pieces(table["t"].combine_chunks(), _PIECE) if len(shared) else ():
            a, b, p, h, sums = _anchor_runs(data, offs, length, m)
            hit, at = find(h, shared)
            many = hit & (total[at] > hot)
            if many.any():
                n = (b - a + 1)[many]
                upto = np.cumsum(n)
                s = np.repeat(a[many] - (upto - n), n) + np.arange(upto[-1])
                windows.append(_window_hash(sums, _second_sums(data), s, length))
            few = np.flatnonzero(hit & ~many)
            if len(few):
                a, b, p, h = a[few], b[few], p[few], h[few]
                parts.append((h, _context_hash(sums, a, b, p, length), a, b + length, p, np.full(len(few), len(held))))
                held.append(data)
        w, second, n = _distinct(*(np.concatenate(x) for x in zip(*windows)))
        out = [_with_kind(to_blocks(chunk, n_blocks, w, [second, (n > 1).astype(np.uint8)]), _WINDOWS)]
        if parts:
            h, c, a, e, p, piece = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
            n = np.diff(np.concatenate([first, [len(h)]]))
            rep = order[first]
            h, c, a, e, p, piece = h[first], c[first], a[rep], e[rep], p[rep], piece[rep]
            block = ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(h)]
            text = [held[k][i:j].tobytes() for k, i, j in zip(piece.tolist(), a.tolist(), e.tolist())]
            cols = [h, c, (p - a).astype(np.uint8), (e - p).astype(np.uint8), (n > 1).astype(np.uint8)]
            rows = [(int(block[i]), chunk, j - i, b"".join([*(planes(x[i:j]) for x in cols), *text[i:j]]))
                    for i, j in zip(cuts, cuts[1:])]
            b_, c_, n_, body = zip(*rows)
            out.append(pa.table({"block": pa.array(b_, pa.int64()), "chunk": pa.array(c_, pa.int64()),
                                 "n": pa.array(n_, pa.int64()), "body": pa.array(body, pa.binary()),
                                 "kind": pa.array([_CONTEXTS] * len(rows), pa.int32())}))
        return pa.concat_tables(out)
    return run


def _matrix(text: np.ndarray, at: np.ndarray, n: np.ndarray, width: int, step: int) -> np.ndarray:
    """(rows, width): n bytes from each place on, forwards or backwards, zeros behind them."""
    out = np.zeros((len(at), width), np.uint8)
    cols = np.arange(width)
    for i in range(0, len(at), 4096):
        inside = cols < n[i:i + 4096, None]
        where = at[i:i + 4096, None] + step * cols
        out[i:i + 4096][inside] = text[where[inside]]
    return out


def extend_backwards(group: np.ndarray, left: np.ndarray, left_n: np.ndarray, right: np.ndarray,
                     right_n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per anchored suffix the least and greatest o at which its string of ``length``
    bytes, begun o bytes before the anchor, is also another suffix's of its group
    (length + 1 and -1: none).

    ``right`` holds the bytes from the anchor on, ``left`` those before it, backwards.
    """
    rows = len(group)
    least, greatest = np.full(rows, length + 1), np.full(rows, -1)
    # by bytes and then by length: a suffix that ends stands before those that go on with NUL bytes
    key = np.concatenate([group.astype(">u8").view(np.uint8).reshape(rows, 8), right,
                          right_n.astype(">u2").view(np.uint8).reshape(rows, 2)], axis=1)
    idx = np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1]}").reshape(rows), kind="stable")
    x = right[idx]
    common = np.full(rows, -1)                      # with the row before; -1: another interval
    if rows > 1:
        differ = x[1:] != x[:-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), right.shape[1])
        n = right_n[idx]
        common[1:] = np.where(group[idx[1:]] == group[idx[:-1]], np.minimum(same, np.minimum(n[1:], n[:-1])), -1)
    for o in range(left.shape[1] + 1):
        hit = np.flatnonzero(common >= max(0, length - o))
        if len(hit):
            r = np.concatenate([idx[hit], idx[hit - 1]])
            greatest[r] = o
            least[r] = np.minimum(least[r], o)
        if o == left.shape[1]:
            break
        gone = left_n[idx] <= o
        byte = np.where(gone, 256, left[idx, o].astype(np.int64))
        start = common < 0
        split = np.zeros(len(idx), bool)
        split[1:] = (byte[1:] != byte[:-1]) & ~start[1:]
        if not (split.any() or gone.any()):
            continue
        inner = np.cumsum(start) - 1
        touched = np.zeros(inner[-1] + 1, bool)
        touched[inner[split]] = True
        touched[inner[gone]] = True
        move = touched[inner]
        rest, rest_common = idx[~move], common[~move]
        at = np.flatnonzero(move & ~gone)
        k = inner[at] * 257 + byte[at]
        order = np.argsort(k, kind="stable")
        at, k = at[order], k[order]
        new = np.full(len(at), -1)
        on = np.flatnonzero(k[1:] == k[:-1]) + 1    # neighbours in the new order: least common prefix between
        if len(on):
            spans = np.column_stack([at[on - 1] + 1, at[on] + 1]).ravel()
            new[on] = np.minimum.reduceat(np.append(common, length), spans)[::2]
        idx, common = np.concatenate([rest, idx[at]]), np.concatenate([rest_common, new])
        alone = common < 0
        alone[:-1] &= common[1:] < 0
        idx, common = idx[~alone], common[~alone]
        if not len(idx):
            break
    return least, greatest


def _resolve_contexts(table: pa.Table, length: int, m: int) -> list[tuple[int, int, int, bytes]]:
    """What repeats of the contexts sent to a block: rows for their chunks."""
    parts, texts, starts, base = [], [], [], 0
    for i, (n, body) in enumerate(zip(table["n"].to_pylist(), table["body"].to_pylist())):
        view = memoryview(body)
        h, c = unplanes(view, n, np.uint64), unplanes(view[8 * n:], n, np.uint64)
        ln, rn, many = (np.frombuffer(view, np.uint8, n, 16 * n + k * n).astype(np.int64) for k in range(3))
        text = np.frombuffer(view, np.uint8, offset=19 * n)
        ends = np.cumsum(ln + rn)
        parts.append((h, c, ln, rn, many, np.full(n, i)))
        starts.append(base + ends - (ln + rn))
        texts.append(text)
        base += len(text)
    h, c, ln, rn, many, sender = (np.concatenate(x) for x in zip(*parts))
    start, text = np.concatenate(starts), np.concatenate(texts)
    order = np.lexsort((c, h))
    first = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])])
    own = np.cumsum(first) - 1                       # the distinct context of each entry, in order
    rep = order[first]
    again = np.bincount(own, weights=1 + many[order]) > 1
    _, group = np.unique(h[rep], return_inverse=True)
    least, greatest = np.where(again, length - rn[rep], length + 1), np.where(again, ln[rep], -1)
    # intervals to extend: an anchor with several contexts, one of which is not yet known to repeat
    open_ = (np.bincount(group) > 1) & (np.bincount(group, weights=~again) > 0)
    rows = np.flatnonzero(open_[group])
    if len(rows):
        r = rep[rows]
        left = _matrix(text, start[r] + ln[r] - 1, ln[r], length - m, -1)
        right = _matrix(text, start[r] + ln[r], rn[r], length, 1)
        lo, hi = extend_backwards(group[rows], left, ln[r], right, rn[r], length)
        least[rows], greatest[rows] = np.minimum(least[rows], lo), np.maximum(greatest[rows], hi)
    hit = greatest >= 0
    entry = np.flatnonzero(hit[own])
    sent, k = sender[order][entry], own[entry]
    out = []
    chunk, block = table["chunk"].to_pylist(), table["block"].to_pylist()
    by = np.lexsort((c[rep][k], sent))
    sent, k = sent[by], k[by]
    edges = np.searchsorted(sent, np.arange(table.num_rows + 1))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            x = k[a:b]
            out.append((block[i], chunk[i], int(b - a), _body(
                c[rep][x], [least[x].astype(np.uint8), greatest[x].astype(np.uint8)])))
    return out


def _any_repeated(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
    second, many = cols                     # entries come sorted by both hashes
    new = np.ones(len(run_of), bool)
    new[1:] = (run_of[1:] != run_of[:-1]) | (second[1:] != second[:-1])
    at, own = np.flatnonzero(new), np.cumsum(new) - 1
    n = np.diff(np.concatenate([at, [len(run_of)]]))
    return ((n > 1) | (np.maximum.reduceat(many, at) > 0))[own], [second]


def _resolve(length: int, m: int):
    windows = merge_in_block([np.uint64, np.uint8], _any_repeated)

    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        out = []
        if (kind == _WINDOWS).any():
            out.append(_with_kind(windows(table.filter(pa.array(kind == _WINDOWS))), _WINDOWS))
        if (kind == _CONTEXTS).any():
            rows = _resolve_contexts(table.filter(pa.array(kind == _CONTEXTS)).combine_chunks(), length, m)
            b, c, n, body = zip(*rows) if rows else ((), (), (), ())
            out.append(pa.table({"block": pa.array(b, pa.int64()), "chunk": pa.array(c, pa.int64()),
                                 "n": pa.array(n, pa.int64()), "body": pa.array(body, pa.binary()),
                                 "kind": pa.array([_CONTEXTS] * len(rows), pa.int32())}))
        return pa.concat_tables(out)
    return run


def _both_found(x: np.ndarray, y: np.ndarray, w: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether each pair (x, y) is among the pairs (w, second), which are sorted and distinct."""
    found = np.zeros(len(x), bool)
    at = np.searchsorted(w, x)
    while True:                             # pairs that share their first half are a rare few
        near = np.minimum(at, len(w) - 1)
        same = (at < len(w)) & (w[near] == x)
        found |= same & (second[near] == y)
        if not (same & ~found).any():
            return found
        at = at + 1


def _cut(length: int, m: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        kind = replies["kind"].to_numpy() if replies.num_rows else np.zeros(0, np.int32)
        # a context's hash may come from any block, so these are sorted anew
        c, least, greatest = joined(replies.filter(pa.array(kind == _CONTEXTS)), [np.uint8, np.uint8])
        order = np.argsort(c)
        c, least, greatest = c[order], least[order].astype(np.int64), greatest[order].astype(np.int64)
        w, second = joined(replies.filter(pa.array(kind == _WINDOWS)), [np.uint64])
        low = np.uint64((1 << 20) - 1)
        maybe = np.zeros(1 << 20, bool)
        maybe[(w & low).astype(np.int64)] = True
        kept, total, gone, spans = [], [], [], []
        for at, to, data, offs in pieces(table["t"].combine_chunks(), _PIECE):
            change = np.zeros(len(data) + 1, np.int32)
            if len(c) or len(w):
                a, b, p, _, sums = _anchor_runs(data, offs, length, m)
                hit, where = find(_context_hash(sums, a, b, p, length), c)
                if hit.any():
                    np.add.at(change, p[hit] - greatest[where[hit]], 1)
                    np.add.at(change, p[hit] - least[where[hit]] + length, -1)
                if len(w):
                    s = window_places(offs, length)
                    x, y = _window_hash(sums, _second_sums(data), s, length)
                    s, x, y = (z[maybe[(x & low).astype(np.int64)]] for z in (s, x, y))
                    s = s[_both_found(x, y, w, second)]
                    np.add.at(change, s, 1)
                    np.add.at(change, s + length, -1)
            drop = np.cumsum(change[:-1]) > 0
            begins = drop.copy()
            begins[1:] &= ~drop[:-1]
            ends_before = offs[:-1][(offs[:-1] < len(data))]
            begins[ends_before] = drop[ends_before]          # spans never cross documents
            n_gone = np.concatenate([[0], np.cumsum(drop)])
            n_begin = np.concatenate([[0], np.cumsum(begins)])
            gone.append(np.diff(n_gone[offs]))
            spans.append(np.diff(n_begin[offs]))
            total.append(np.diff(offs))
            left = data[~drop].tobytes()
            cut = offs - n_gone[offs]
            kept += [left[i:j] for i, j in zip(cut.tolist(), cut[1:].tolist())]
        ids = table["doc_id"].to_numpy() if table.num_rows else np.zeros(0, np.int64)
        num = lambda x: pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64))
        return pa.table({"doc_id": pa.array(ids, mask=ids == NULL_ID), "kept": pa.array(kept, pa.binary()),
                         "n_bytes": num(total), "n_removed": num(gone), "n_spans": num(spans)})
    return run


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) per document; ``kept`` holds the bytes that stay."""
    if not 0 < anchor < length < 256:
        raise ValueError("anchors are shorter than the strings, which have under 256 bytes")
    n = block_count(docs, text_col)
    t = chunked(docs, n, id_col, text_col, by_row=True)
    anchors = per_block(per_chunk(t, _send_anchors(length, anchor, n), PACKED), [np.uint32], _repeated)
    sent = with_replies(t, anchors, _send_contexts(length, anchor, n, hot), _KINDS)
    found = sent.groupBy("block").applyInArrow(_resolve(length, anchor), _KINDS)
    return with_replies(t, found, _cut(length, anchor), _TEXT)
