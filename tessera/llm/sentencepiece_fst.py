"""Operator 5, SentencePiece encoding and decoding by a weighted transducer.

The model file is compiled to a transducer in three parts: the normaliser
(dummy prefix, spaces to the piece mark), the pieces (an arc reads a piece's
text and writes its id) and the byte fallback (a character that is no piece
is written as its bytes). Composing it with an input gives a lattice whose
tropical shortest path is the encoding.

For a unigram model an arc weighs minus its score. For a BPE model (the given
one) sums of scores are not what BPE minimises, so the transducer remembers
the last piece: the arc of piece b after piece a weighs nothing if a and b are
what the merges make of their joint text, and infinity (the semiring's zero)
if not. A segmentation is BPE's exactly if all its neighbours fit, hence the
path of finite weight is unique, and so is the best last piece of every
prefix. Which pairs fit is compiled on demand and kept.

No piece crosses from another character into the mark, so the lattice falls
apart into words, and equal words are composed once per worker. Tests hold ids
and texts against the sentencepiece library.

Defined results: null and empty text have no ids and decode to the empty text;
long runs without a space are one long word (linear time); repeated rows and
null ids are carried through; an empty table gives an empty result. A mark
character in a text decodes to a space, as in the library.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words (as many prefixes, as many pairs) that a worker remembers before it starts anew.
MEMORY = 600_000
_INF = float("inf")


class Transducer:
    """Normaliser, pieces and byte fallback of one model, compiled."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces:
            raise ValueError("only identity normalisers with escaped spaces are compiled")
        if m.trainer_spec.treat_whitespace_as_suffix or m.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with leading marks are compiled")
        self.bpe = m.trainer_spec.model_type == BPE
        self.prefix = MARK if n.add_dummy_prefix else ""
        self.pieces = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (NORMAL, USER)}
        if any(p.type == USER for p in m.pieces) or any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("pieces that cross words are not compiled")
        self.score = [p.score for p in m.pieces]
        self.longest = max(map(len, self.pieces))
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN)
        self.text = [p.piece for p in m.pieces]
        self.out = [b"" if p.type == CONTROL else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
                    else p.piece.replace(MARK, " ").encode() for p in m.pieces]
        self.out[self.unknown] = m.trainer_spec.unk_surface.encode()
        sizes = np.array([len(o) for o in self.out], np.int64)
        self.out_size, self.out_first = sizes, np.cumsum(sizes) - sizes
        self.out_bytes = np.frombuffer(b"".join(self.out), np.uint8)
        #: The pieces as a trie read from their ends: all arcs into a place are found in one walk back.
        self.ending: dict = {}
        for text, i in self.pieces.items():
            node = self.ending
            for c in reversed(text):
                node = node.setdefault(c, {})
            node[""] = i
        self.length = [len(t) for t in self.text]
        self.fit: dict[int, bool] = {}
        self.last: dict[str, int] = {}
        self.clear_words()

    def clear_words(self) -> None:
        self.known: dict[str, int] = {}
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.int32)
        self.used = 0

    def fallback(self, c: str) -> list[int]:
        return [self.byte_id.get(b, self.unknown) for b in c.encode()] if self.byte_id else [self.unknown]

    def _merged(self, text: str) -> list[str]:
        """What the merges make of a short text: best-scored neighbours first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -_INF, -1
            for i in range(len(parts) - 1):
                p = self.pieces.get(parts[i] + parts[i + 1])
                if p is not None and self.score[p] > best:
                    best, at = self.score[p], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a (a = -1: the start, or a character that is no piece)."""
        key = (a << 32) | b
        r = self.fit.get(key)
        if r is None:
            t = self.text[b]
            r = self._merged(t) == [t] if a < 0 else (
                self.fits(-1, b) and self._merged(self.text[a] + t) == [self.text[a], t])
            self.fit[key] = r
        return r

    def _shortest_bpe(self, word: str) -> list[int]:
        """The finite path; ``last`` keeps the last piece of every prefix seen before."""
        n, last, fit, ending, length = len(word), self.last, self.fit, self.ending, self.length
        ends = [-1] * (n + 1)
        keep = n <= 64                      # prefixes of very long words are not worth remembering
        for i in range(1, n + 1):
            p = last.get(word[:i]) if keep else None
            if p is None:
                p, node, j, found = -1, ending, i, []
                while j:
                    j -= 1
                    node = node.get(word[j])
                    if node is None:
                        break
                    t = node.get("")
                    if t is not None:
                        found.append((j, t))
                for j, t in reversed(found):
                    a = ends[j]
                    r = fit.get((a << 32) | t)
                    if r if r is not None else self.fits(a, t):
                        p = t
                        break
                if keep:
                    last[word[:i]] = p
            ends[i] = p
        out: list[int] = []
        i = n
        while i:
            p = ends[i]
            if p >= 0:
                out.append(p)
                i -= length[p]
            else:
                out += self.fallback(word[i - 1])[::-1]
                i -= 1
        out.reverse()
        return out

    def _shortest_unigram(self, word: str) -> list[int]:
        n = len(word)
        cost = [0.0] + [_INF] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        floor = min(self.score) - 10.0       # weight of a character that is no piece
        for i in range(1, n + 1):
            for j in range(max(0, i - self.longest), i):
                t = self.pieces.get(word[j:i])
                w = -self.score[t] if t is not None else -floor if j == i - 1 else _INF
                if cost[j] + w < cost[i]:
                    cost[i], back[i] = cost[j] + w, (j, -1 if t is None else t)
        out, i = [], n
        while i:
            j, t = back[i]
            out.append([t] if t >= 0 else self.fallback(word[j:i]))
            i = j
        return list(chain.from_iterable(reversed(out)))

    def words(self, text: str) -> list[str]:
        """The normalised text, cut before each run of marks; one mark of each word is left out.

        (The first word of a model without a dummy prefix starts with no mark at
        all, which a leading NUL tells; see ``_marked``.)
        """
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if self.prefix and "" not in parts:
            return parts
        # further marks of a run belong to the word that follows them
        out, marks = [], 1 if self.prefix else 0
        for k, p in enumerate(parts):
            marks += k > 0
            if p:
                out.append(MARK * (marks - 1) + p if marks else "\0" + p)
                marks = 0
        if marks:
            out.append(MARK * (marks - 1))
        return out

    def _marked(self, word: str) -> str:
        """The word as the pieces have it."""
        return word[1:] if not self.prefix and word.startswith("\0") else MARK + word

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        b = np.zeros(max(n, 2 * len(a)), a.dtype)
        b[:len(a)] = a
        return b

    def _learn(self, new: list[str]) -> None:
        path = self._shortest_bpe if self.bpe else self._shortest_unigram
        ids = [path(self._marked(w)) for w in new]
        k, n = len(self.known), len(new)
        size = np.fromiter(map(len, ids), np.int64, n)
        self.first, self.count = self._room(self.first, k + n), self._room(self.count, k + n)
        self.first[k:k + n] = self.used + np.cumsum(size) - size
        self.count[k:k + n] = size
        total = int(size.sum())
        self.ids = self._room(self.ids, self.used + total)
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.used += total
        self.known.update(zip(new, range(k, k + n)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another; where each text's ids begin (and the end)."""
        words: list[str] = []
        ends = [0]
        for t in texts:
            words += self.words(t)
            ends.append(len(words))
        if len(self.known) > MEMORY:
            self.clear_words()
        for memo in (self.last, self.fit):
            if len(memo) > MEMORY:
                memo.clear()
        get = self.known.get
        code = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        if len(miss := np.flatnonzero(code < 0).tolist()):
            self._learn(list(dict.fromkeys([words[i] for i in miss])))
            code[miss] = [get(words[i]) for i in miss]
        size = self.count[code]
        upto = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[code] - upto[:-1], size)
        at += np.arange(len(at))
        return self.ids[at], upto[np.array(ends, np.int64)]

    def decode(self, ids: np.ndarray, upto: np.ndarray) -> list[str]:
        """The texts of ids that stand one after another; the dummy prefix goes, bytes that
        are no UTF-8 become U+FFFD."""
        size = self.out_size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.out_first[ids] - ends[:-1], size)
        at += np.arange(len(at))
        data = self.out_bytes[at].tobytes()
        cut = ends[upto].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in texts]


def transducer(path: str) -> Transducer:
    """The worker process's transducer: compiled once per model, kept from task to task."""
    import sentencepiece
    kept = vars(sentencepiece).setdefault("_kept_transducers", {})
    if path not in kept:
        kept[path] = Transducer(path)
    return kept[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = transducer(path)
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            parts, sizes, at = [], [], 0
            while at < len(texts):           # about 1 MB of text at a time
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to]) <= 1 << 20):
                    held += len(texts[to])
                    to += 1
                ids, upto = t.encode(texts[at:to])
                parts.append(ids)
                sizes.append(np.diff(upto))
                at = to
            offs = np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int32)
            ids = pa.array(np.concatenate([*parts, np.zeros(0, np.int32)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(offs), ids)],
                                             [*b.schema.names, "ids"])
    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = transducer(path)
            col = b.column(b.schema.get_field_index("ids"))
            ids = col.flatten().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy())]).astype(np.int64)
            texts: list[str] = []
            at = 0
            while at < len(col):             # about 1M ids at a time
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + (1 << 20), "right")) - 1)
                texts += t.decode(ids[upto[at]:upto[to]], upto[at:to + 1] - upto[at])
                at = to
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             [*b.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null as empty), ids (array of int)."""
    small_batches(docs.sparkSession)
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return t.mapInArrow(_encode(model), "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The encoded rows with ``decoded``, the text of their ids."""
    small_batches(encoded.sparkSession)
    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes) + ", decoded string"
    return encoded.mapInArrow(_decode(model), schema)
