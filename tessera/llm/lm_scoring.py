"""Operator 4, LM scoring: cross-entropy difference of two matched n-gram models.

A target model (labelled good documents) and a background model (all
documents) have the same order, the same smoothing and the same vocabulary:
every word that the whole corpus holds ``MIN_COUNT`` times, all others being
<unk>. A document's score is the mean per-token loss under the target model
minus that under the background model: the lower, the more the document is
like the target.

Counts cover all documents and are exact. Both models are one table of
bigrams, which grows with the input and is never gathered; documents are dealt
into chunks and the table into blocks (see ``blocks``).

1. Word counts are collapsed per worker batch and then per word; from them
   come the vocabulary's size and, by count, its words.
2. A chunk sends its distinct words and gets back, by place, the ids of those
   in the vocabulary.
3. A chunk sends each of its distinct bigrams once, with its counts in both
   models. A bigram's key is a permutation of (id, id), so no two bigrams share
   one; a frequent bigram is one entry per chunk. The counts of a word, and of
   a word as left side, are entries too, with ``TOTAL`` in the other place.
4. Blocks add up and send each chunk those totals that differ from its own
   counts, from which and from these the chunk scores its documents. Most
   bigrams occur in one chunk only and need no answer.

``P(w | v) = (c(v, w) + PRIOR * P(w)) / (c(v) + PRIOR)`` with
``P(w) = (c(w) + 1) / (N + size)``; a text's first word follows a start token.
Words are told apart by 64-bit hashes. A bigram's key holds two ids of 32
bits, so a vocabulary of 2 ** 32 ids or more is refused with an error, never
mixed up; ``vocabulary`` then bounds it by count.

Defined results: null and empty text have 0 tokens and null losses and score;
labels that repeat an id count once, null ids and labels not at all; without
target rows the target model is uniform over the vocabulary; rows that repeat
a doc_id are each counted and scored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (NULL_ID, PACKED, block_count, block_of, chunk_of, chunked, marked, packed, per_block, per_chunk,
                     placed, to_blocks, unmarked, unpack, with_replies)
from .common import small_batches, staged, text_of, unstage
from .words import mix64, pieces, word_hashes, word_spans

#: Words with fewer occurrences in the whole corpus are <unk>.
MIN_COUNT = 2
#: Tokens for each block of the bigram table: the number of blocks follows the input.
CELLS = 1 << 20
PRIOR = 16.0
#: Ids of <unk>, of the start token, and of the place that stands for any word; words have the ids after them.
UNK, START, TOTAL, FIRST = range(4)
#: Blocks of the bigram table are numbered from here, and a chunk's target ids are block -1.
PAIRS = 1 << 40


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def out():
        h, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["word", "n"])

    for b in batches:
        for _, _, data, offs in pieces(b.column(0)):
            s, e, _ = word_spans(data, offs)
            held.append(word_hashes(data, s, e, lower=True))
            size += len(s)
        if size > 4_000_000:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _vocabulary(docs: DataFrame, text_col: str, size: int | None, n_blocks: int) -> tuple[int, int, int, int]:
    """(least count, words, most words of a block, tokens): four numbers that define the vocabulary."""
    t = docs.select(text_of(text_col).alias("t"))
    counts = staged(t.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
                    "word-counts")
    least = MIN_COUNT
    if size is not None:
        least = counts.orderBy(F.desc("n")).limit(size).agg(F.min("n")).first()[0] or 1
    block = F.shiftrightunsigned(F.shiftrightunsigned("word", 32) * F.lit(n_blocks).cast("long"), 32)
    kept = counts.where(F.col("n") >= least).groupBy(block.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    words, most = kept.agg(F.sum("c"), F.max("c")).first()
    tokens = counts.agg(F.sum("n")).first()[0]
    unstage(counts)
    return least, words or 0, most or 0, tokens or 0


class _Tokens:
    """A chunk's words as places in its own short list of ids: <unk>, start, then its vocabulary words."""

    def __init__(self, table: pa.Table, replies: pa.Table, n_blocks: int):
        rows, hashes, firsts, n = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for at, _, data, offs in pieces(table["t"].combine_chunks()):
            s, e, first = word_spans(data, offs)
            hashes.append(word_hashes(data, s, e, lower=True))
            rows.append(np.repeat(np.arange(len(offs) - 1), np.diff(first)) + at)
            firsts.append(first[:-1][np.diff(first) > 0] + n)
            n += len(s)
        sent, word = np.unique(np.concatenate(hashes), return_inverse=True)
        kept, rank = placed(sent, n_blocks, replies, [np.uint32])
        block = block_of(sent[kept], n_blocks)
        self.ids = np.concatenate([np.array([UNK, START], np.uint64),
                                   rank.astype(np.uint64) * np.uint64(n_blocks) + block + np.uint64(FIRST)])
        place = np.full(len(sent), UNK)
        place[kept] = np.arange(len(kept)) + 2
        self.row, word = np.concatenate(rows), place[word]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[np.concatenate(firsts)] = START
        # each bigram once: its two places, and for each token the bigram it ends
        code, self.pair = np.unique(before * len(self.ids) + word, return_inverse=True)
        self.before, self.word = code // len(self.ids), code % len(self.ids)


def _keys(v: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
    """One key per (id, id): a permutation of 2 * bits bits (three Feistel rounds), in the highest bits."""
    mask = np.uint64((1 << bits) - 1)
    w = w ^ (mix64(v, 7) & mask)
    v = v ^ (mix64(w, 8) & mask)
    w = w ^ (mix64(v, 9) & mask)
    return (v << np.uint64(bits) | w) << np.uint64(64 - 2 * bits)


def _send_words(n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        held = [np.zeros(0, np.uint64)]
        for _, _, data, offs in pieces(table["t"].combine_chunks()):
            s, e, _ = word_spans(data, offs)
            held.append(word_hashes(data, s, e, lower=True))
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return to_blocks(table["chunk"][0].as_py(), n_blocks, h, [n.astype(np.uint32)])
    return run


def _number(least: int):
    """Of a block's words those of the vocabulary, with their place among them."""
    def merge(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
        kept = np.add.reduceat(cols[0].astype(np.int64), first) >= least
        return kept[run_of], [(np.cumsum(kept) - 1).astype(np.uint32)[run_of]]
    return merge


def _pack_ids(table: pa.Table) -> pa.Table:
    ids = table["doc_id"].to_numpy()
    return packed([(-1, table["chunk"][0].as_py(), len(ids), ids.tobytes())])


def _entries(table: pa.Table, replies: pa.Table, n_blocks: int, bits: int):
    """A chunk's tokens and its own counts: (tokens, keys, [background, target] counts).

    Keys are of its bigrams, then of its words, its left sides, and of all tokens.
    """
    block = replies["block"].to_numpy() if replies.num_rows else np.zeros(0, np.int64)
    good = [np.frombuffer(b, np.int64) for b in replies.filter(pa.array(block < 0))["body"].to_pylist()]
    good = np.isin(table["doc_id"].to_numpy(), np.concatenate(good)) if good else np.zeros(table.num_rows, bool)
    k = _Tokens(table, replies.filter(pa.array((block >= 0) & (block < PAIRS))), n_blocks)
    both = (np.bincount(k.pair, minlength=len(k.word)),
            np.bincount(k.pair[good[k.row]], minlength=len(k.word)))
    v, w = k.ids[k.before], k.ids[k.word]
    total = np.full(len(k.ids), TOTAL, np.uint64)
    key = _keys(np.concatenate([v, total, k.ids, total[:1]]), np.concatenate([w, k.ids, total, total[:1]]), bits)

    def of(at, n):
        return np.bincount(at, weights=n, minlength=len(k.ids)).astype(np.int64)
    return k, key, [np.concatenate([n, of(k.word, n), of(k.before, n), [n.sum()]]).astype(np.int64) for n in both]


def _send_pairs(n_blocks: int, n_pair_blocks: int, bits: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return packed([])
        _, key, counts = _entries(table, replies, n_blocks, bits)
        order = np.argsort(key)
        return to_blocks(table["chunk"][0].as_py(), n_pair_blocks, key[order],
                         [c[order].astype(np.uint32) for c in counts])
    return run


def _add(table: pa.Table) -> pa.Table:
    """Totals of a block's entries, sent back by place: a chunk knows what it sent in which order.

    A body has a bit for each entry sent, set where the total differs from what
    was sent, and then these totals. What only one chunk has needs no answer.
    """
    table = table.combine_chunks()
    rows = unpack(table, [np.uint32, np.uint32])
    h = np.concatenate([r[0] for r in rows])
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    own = [np.concatenate([r[c] for r in rows]).astype(np.int64) for c in (1, 2)]
    totals = [np.empty(len(h), np.int64) for _ in own]
    for c, total in zip(own, totals):
        total[order] = np.add.reduceat(c[order], first)[run]
    differs = (totals[0] != own[0]) | (totals[1] != own[1])
    ends = np.cumsum([len(r[0]) for r in rows])
    out = []
    for b, c, a, e in zip(table["block"].to_pylist(), table["chunk"].to_pylist(), [0, *ends.tolist()], ends.tolist()):
        if differs[a:e].any():
            out.append((b, c, *marked(differs[a:e], [x[a:e] for x in totals])))
    return packed(out)


def _answered(order: np.ndarray, key: np.ndarray, counts: list[np.ndarray], replies: pa.Table, n_blocks: int) -> None:
    """Put the totals of the replies in place of a chunk's own counts; ``order`` sorts its keys."""
    block = block_of(key[order], n_blocks)
    for b, n, body in zip(*(replies[c].to_pylist() for c in ("block", "n", "body"))):
        lo, hi = np.searchsorted(block, np.array([b - PAIRS, b - PAIRS + 1], np.uint64)).tolist()
        at, totals = unmarked(body, hi - lo, n, [np.int64, np.int64])
        for c, total in zip(counts, totals):
            c[order[lo:hi][at]] = total


def _scores(n_blocks: int, n_pair_blocks: int, bits: int, size: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = table.num_rows
        block = replies["block"].to_numpy() if replies.num_rows else np.zeros(0, np.int64)
        n, losses = np.zeros(rows, np.int64), [np.zeros(rows), np.zeros(rows)]
        if rows:
            k, key, counts = _entries(table, replies, n_blocks, bits)
            _answered(np.argsort(key), key, counts, replies.filter(pa.array(block >= PAIRS)), n_pair_blocks)
            pairs, words = len(k.word), len(k.ids)
            n = np.bincount(k.row, minlength=rows)
            for m, count in enumerate(c.astype(float) for c in counts):
                pair, word = count[:pairs], count[pairs:pairs + words]
                left, tokens = count[pairs + words:-1], count[-1]
                p = (word + 1) / (tokens + size)
                q = (pair + PRIOR * p[k.word]) / (left[k.before] + PRIOR)
                losses[m] = np.bincount(k.row, weights=-np.log(q)[k.pair], minlength=rows) / np.maximum(n, 1)
        background, target = losses
        ids = table["doc_id"].to_numpy() if rows else np.zeros(0, np.int64)
        none = n == 0
        return pa.table({"doc_id": pa.array(ids, mask=ids == NULL_ID), "n_tokens": pa.array(n.astype(np.int64)),
                         "target_loss": pa.array(target, mask=none),
                         "background_loss": pa.array(background, mask=none),
                         "score": pa.array(target - background, mask=none)})
    return run


def good_documents(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The ids labelled 1, each once."""
    return (labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc_id")).distinct())


def cross_entropy_difference(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             vocabulary: int | None = None, cells: int = CELLS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every document.

    ``vocabulary`` takes the most frequent words only, that many and those as
    frequent as the last; ``cells`` sizes the blocks of the bigram table.
    """
    small_batches(docs.sparkSession)
    blocks = block_count(docs, text_col)
    least, words, most, tokens = _vocabulary(docs, text_col, vocabulary, blocks)
    bits = (FIRST + most * blocks).bit_length()
    if bits > 32:
        raise ValueError("the vocabulary has more ids than a bigram's key can hold")
    pair_blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // cells))
    t = chunked(docs, blocks, id_col, text_col).select("chunk", "doc_id", "t")
    target = good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().where(F.col("doc_id") != NULL_ID)
    target = per_chunk(target.select(chunk_of(F.col("doc_id"), blocks).alias("chunk"), "doc_id"), _pack_ids, PACKED)
    ids = per_block(per_chunk(t, _send_words(blocks), PACKED), [np.uint32], _number(least), by_place=True)
    pairs = with_replies(t, ids.unionByName(target), _send_pairs(blocks, pair_blocks, bits), PACKED)
    totals = pairs.groupBy("block").applyInArrow(_add, PACKED).withColumn("block", F.col("block") + F.lit(PAIRS))
    return with_replies(t, ids.unionByName(target).unionByName(totals), _scores(blocks, pair_blocks, bits, words + 2),
                        "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
