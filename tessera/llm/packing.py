"""Operator 10, packing: harmonic packing of token pieces into fixed sequences.

Each document becomes token ids (public tokenizer, no special tokens, then one
end id). Ids are cut into pieces whose lengths are reciprocals of the
capacity: whole capacities first, then greedily the largest floor(C / k) that
still fits the rest. A piece of class k has floor(C / k) ids, and a sequence
of class k holds exactly k such pieces, so it wastes less than k ids and at
most C mod k of them. There are fewer than 2 * sqrt(C) classes, whatever the
data.

Workers fill bins independently: a task numbers its pieces within each class;
a table with one row per (task, class) gives each task the class's first free
slot; sequence and offset are then arithmetic on the slot number. No piece is
shuffled with its ids and no class is gathered in one task. What is left over
is at most one unfilled bin per class, under 5 * C pieces in all however large
the input; these are packed by first-fit decreasing.

Defined results: null or empty text is the end id alone; a null doc_id is
carried through; repeated rows are packed once per row; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, text_of

CAPACITY = 4096
END_ID = 2
#: Words whose ids a worker remembers at once; beyond it the memory starts anew.
WORD_MEMORY = 1_000_000
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def reciprocal_cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths that n ids are cut into: each is floor(capacity / k) for some k."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        size = capacity // -(-capacity // rest)
        out.append(size)
        rest -= size
    return out


class WordEncoder:
    """Token ids of white-space separated words, each new word encoded once.

    For tokenizers that lower-case, drop white space and split letters from
    what stands after them (``word_bpe_49k.json``; the constructor refuses one
    that does not): the ids of a text are then the ids of its words in turn,
    and those of a word are the ids of its lower-cased letters and of the
    punctuation run that ends it. Tests hold this against whole texts.

    What is still unknown is encoded in one call, its units parted by a special
    token whose id no unit has.
    """

    def __init__(self, path: str, memory: int = WORD_MEMORY):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if not added:
            raise ValueError(f"{path} has no special token to part words with")
        self.parting_id, self.parting = min(added.items())
        #: A unit with one of these may hold a special token: it is encoded alone and as it stands.
        self.marks = tuple({t.encode()[:2] for t in added.values()})
        self.memory = memory
        self.clear()
        one = self._whole("Word, two.")
        if one != self._whole("word") + self._whole(",") + self._whole("two") + self._whole("."):
            raise ValueError(f"{path} does not encode texts word by word")

    def clear(self) -> None:
        #: Word or unit -> code; a code's ids are ids[first : first + count].
        self.known: dict[bytes, int] = {}
        self.codes = 0
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        b = np.zeros(max(n, 2 * len(a)), a.dtype)
        b[:len(a)] = a
        return b

    def _add(self, names: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        """New codes for names, whose ids stand one after another in ``ids``."""
        k, n = self.codes, len(names)
        self.first, self.count = self._room(self.first, k + n), self._room(self.count, k + n)
        self.first[k:k + n] = self.used + np.cumsum(sizes) - sizes
        self.count[k:k + n] = sizes
        self.ids = self._room(self.ids, self.used + len(ids))
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.codes += n
        self.known.update(zip(names, range(k, k + n)))

    def _ids_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of codes, one after another, and where each code's begin (and the end)."""
        size = self.count[code]
        upto = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[code] - upto[:-1], size)
        at += np.arange(len(at))
        return self.ids[at], upto

    def _learn_units(self, new: list[bytes]) -> None:
        for at in range(0, len(new), 2000):
            some = new[at:at + 2000]
            ids = np.array(self._whole(self.parting.join([u.decode() for u in some])) + [self.parting_id], np.uint32)
            ends = np.flatnonzero(ids == self.parting_id)
            self._add(some, np.diff(np.concatenate([[-1], ends])) - 1, ids[ids != self.parting_id])

    def _learn(self, words: list[bytes]) -> None:
        known, marks = self.known, self.marks
        new: dict[bytes, None] = {}
        same: list[tuple[bytes, bytes]] = []
        made: list[tuple[bytes, bytes, bytes]] = []
        for w in words:
            for m in marks:
                if m in w:
                    ids = np.array(self._whole(w.decode()), np.uint32)
                    self._add([w], np.array([len(ids)]), ids)
                    break
            else:
                low = w.lower()
                stem = low.rstrip(PUNCTUATION)
                if len(stem) < len(low) and stem and 97 <= stem[-1] <= 122:
                    tail = low[len(stem):]
                    made.append((w, stem, tail))
                    if tail not in known:
                        new[tail] = None
                else:
                    stem = low
                    if low != w:
                        same.append((w, low))
                if stem not in known:
                    new[stem] = None
        if new:
            self._learn_units(list(new))
        known.update([(w, known[low]) for w, low in same])
        if made:
            code = np.array([(known[a], known[b]) for _, a, b in made], np.int64)
            ids, _ = self._ids_of(code.ravel())
            self._add([w for w, _, _ in made], self.count[code].sum(axis=1), ids)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another; where each text's ids begin (and the end)."""
        words: list[bytes] = []
        ends = [0]
        for t in texts:
            words += t.split()
            ends.append(len(words))
        if len(self.known) > self.memory:
            self.clear()
        get = self.known.get
        code = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        miss = np.flatnonzero(code < 0).tolist()
        if miss:
            self._learn(list(dict.fromkeys([words[i] for i in miss])))
            code[miss] = [get(words[i]) for i in miss]
        ids, upto = self._ids_of(code)
        return ids, upto[np.array(ends, np.int64)]


def word_encoder(path: str) -> WordEncoder:
    """The worker process's encoder: one per tokenizer, kept from task to task."""
    import tokenizers
    kept = vars(tokenizers).setdefault("_kept_word_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def _cut_batches(path: str, capacity: int, end_id: int, keep_ids: bool):
    cuts = {r: reciprocal_cuts(r, capacity) for r in range(1, capacity)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        encoder = None
        end = np.array([end_id], "<u4")
        slot: dict[int, int] = {}
        for b in batches:
            encoder = encoder or word_encoder(path)
            doc, text = b.column(0), b.column(1)
            rows: list[tuple] = []
            parts: list[np.ndarray] = []
            data = text.cast(pa.large_binary()).to_pylist()
            at = 0
            while at < len(data):      # about 1 MB of text at a time
                to, held = at, 0
                while to < len(data) and (to == at or held + len(data[to]) <= 1 << 20):
                    held += len(data[to])
                    to += 1
                ids, upto = encoder.encode(data[at:to])
                ids = ids.astype("<u4", copy=False)
                for j in range(to - at):
                    own = np.concatenate([ids[upto[j]:upto[j + 1]], end])
                    n, start = len(own), 0
                    for size in [capacity] * (n // capacity) + cuts.get(n % capacity, []):
                        k = capacity // size
                        piece = own[start:start + size]
                        rows.append((at + j, k, slot.get(k, 0), start, size, zlib.crc32(piece), n))
                        if keep_ids:
                            parts.append(piece)
                        slot[k] = slot.get(k, 0) + 1
                        start += size
                at = to
            if not rows:
                continue
            r = np.array(rows, np.int64)
            cols = [pa.array(np.full(len(r), task, np.int64)), pa.array(r[:, 1]), pa.array(r[:, 2]),
                    doc.take(pa.array(r[:, 0])), pa.array(r[:, 3]), pa.array(r[:, 4]), pa.array(r[:, 5]),
                    pa.array(r[:, 6])]
            names = ["task", "k", "slot", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                cols.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, numbered per (task, class), as a written table."""
    small_batches(docs.sparkSession)
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    schema = ("task long, k long, slot long, doc_id long, start long, length long, ids_crc32 long, "
              "doc_tokens long" + (", ids array<long>" if keep_ids else ""))
    return staged(t.mapInArrow(_cut_batches(tokenizer, capacity, end_id, keep_ids), schema), "pieces")


def _first_fit_decreasing(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "slot"], ascending=[False, True], kind="stable")
        free: list[int] = []
        bins, offs = [], []
        last, at = None, 0
        for n in pdf["length"]:
            if n != last:
                last, at = n, 0
            while at < len(free) and free[at] < n:
                at += 1
            if at == len(free):
                free.append(capacity)
            bins.append(at)
            offs.append(capacity - free[at])
            free[at] -= n
        return pdf.assign(sequence_id=pdf["sequence_id"] + np.array(bins, np.int64),
                          offset=np.array(offs, np.int64))
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    pieces = token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, keep_ids)
    per = pieces.groupBy("task", "k").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("k").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per = staged(per.select("task", "k", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")),
                 "piece-counts")
    # one row per class, fewer than 2 * sqrt(capacity) of them
    classes = per.groupBy("k").agg(F.sum("n").alias("total"))
    classes = classes.withColumn("bins", F.expr("total div k"))
    upto = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("base", F.coalesce(F.sum("bins").over(upto), F.lit(0)))
    classes = classes.withColumn("all_bins", F.sum("bins").over(Window.partitionBy()))
    classes = F.broadcast(classes.select("k", "bins", "base", "all_bins"))
    slots = (pieces.join(per.select("task", "k", "skip"), ["task", "k"]).join(classes, "k")
             .withColumn("slot", F.col("skip") + F.col("slot")))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if keep_ids else [])
    bin_ = F.expr("slot div k")
    full = slots.where(bin_ < F.col("bins")).select(
        *keep, (F.col("base") + bin_).cast("long").alias("sequence_id"),
        (F.expr("slot % k") * F.col("length")).cast("long").alias("offset"))
    rest = slots.where(bin_ >= F.col("bins")).select(
        *keep, F.col("slot").cast("long").alias("slot"), F.col("all_bins").cast("long").alias("sequence_id"))
    rest = rest.withColumn("offset", F.lit(0).cast("long")).withColumn("rest", F.lit(0))
    # at most k - 1 pieces of each class: a bounded number, so one task takes them
    rest = rest.groupBy("rest").applyInPandas(_first_fit_decreasing(capacity), rest.schema).drop("slot", "rest")
    return full.unionByName(rest)
