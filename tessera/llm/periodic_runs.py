"""Operator 12, periodic run detection: recursive frequency splitting, then a lag scan.

A *run* is a stretch of consecutive words (``[^\\x20\\x09-\\x0D]+``) of one
document with smallest period q and at least ``max(min_words, 3 * q)`` words
that no neighbouring word extends. Each document is worked on by itself, and
many at once, as arrays of word hashes:

1. *Frequency splitting.* A run of period q holds each of its words once per
   period, so three times or more. A word that its segment holds fewer than
   three times is in no run: it splits the segment, parts under ``min_words``
   words go, and the rest are counted again, until no segment changes.
   Ordinary prose is gone after a round or two.
2. *Lag scan.* For lags up to 8 the surviving segments are compared with
   themselves, shifted. For greater lags, one octave (n/2, n] at a time, only
   at lags at which an n-gram returns: inside a run of period q <= n whose
   length is at least q + n (3q is), the next place of an n-gram is exactly q
   words on, since the q-grams of one period are all different. So the places
   whose n-gram next returns d words on, for n/2 < d <= n, form one unbroken
   stretch for each run of period d, and this stretch gives its ends. Cost:
   a sort per octave, whatever the number of lags.
3. *Check.* Words were compared by 64-bit hashes. Each run found is compared
   word by word; a document in which that fails is done again with numbers
   from a dictionary of its words.

``collapsed`` text is the words outside the runs and each run's first period,
joined by one space.

Defined results: null, empty and blank texts have no words, no runs and an
empty text; a null doc_id is carried through; repeated rows are judged row by
row; runs may overlap (each is reported); an empty table gives an empty
result; only the id and text columns are read. There is no shuffle, and a
task's memory is that of its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .words import mix64, pieces, word_hashes, word_spans

MIN_WORDS = 24
REPEATS = 3
#: Lags compared directly; greater ones by octaves.
DIRECT = 8
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
_NO_RUNS = np.zeros((0, 3), np.int64)


def _stretches(at: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the unbroken stretches of ascending places with equal ``same``."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = at[1:] != at[:-1] + 1
    for s in same:
        cut |= s[1:] != s[:-1]
    first = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return first, np.concatenate([first[1:], [len(at)]]) - 1


def frequent_segments(word: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """[starts, ends] of the segments in which every word occurs three times or more.

    ``word``: word numbers of many texts one after another; ``first``: each
    text's first word, and the end.
    """
    lens = np.diff(first)
    long = lens >= min_words
    start, end = first[:-1][long], first[1:][long]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    n_words = int(word.max()) + 1 if len(word) else 0
    while len(start):
        size = end - start
        seg = np.repeat(np.arange(len(start)), size)
        base = np.cumsum(size) - size
        at = np.arange(len(seg)) - np.repeat(base, size) + np.repeat(start, size)
        key = seg * n_words + word[at]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.ones(len(key), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        run = np.cumsum(new) - 1
        rare = np.empty(len(key), bool)
        rare[order] = np.bincount(run)[run] < REPEATS
        split = np.bincount(seg[rare], minlength=len(start)) > 0
        done.append((start[~split], end[~split]))
        left = ~rare & split[seg]
        at, seg = at[left], seg[left]
        a, b = _stretches(at, seg)
        start, end = at[a], at[b] + 1
        keep = end - start >= min_words
        start, end = start[keep], end[keep]
    starts = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    ends = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int64)
    order = np.argsort(starts)
    return [starts[order], ends[order]]


def _direct_lags(word: np.ndarray, seg: np.ndarray, min_words: int) -> list[np.ndarray]:
    """Runs of period up to DIRECT: (start, length, period), starts as indexes of ``word``."""
    found: list[np.ndarray] = []
    ends_of: np.ndarray = np.zeros(0, np.int64)     # start * (size + 1) + length of runs of smaller periods
    size = len(word) + 1
    for lag in range(1, min(DIRECT, len(word) - 1) + 1):
        at = np.flatnonzero((word[lag:] == word[:-lag]) & (seg[lag:] == seg[:-lag]))
        a, b = _stretches(at)
        start, length = at[a], b - a + 1 + lag
        keep = length >= max(min_words, REPEATS * lag)
        start, length = start[keep], length[keep]
        # a run of a multiple of its smallest period has the same bounds as under that period
        key = start * size + length
        new = ~np.isin(key, ends_of)
        ends_of = np.concatenate([ends_of, key[new]])
        found.append(np.stack([start[new], length[new], np.full(new.sum(), lag)], axis=1))
    return found


def _octave_lags(word: np.ndarray, seg: np.ndarray, min_words: int) -> list[np.ndarray]:
    """Runs of period over DIRECT, by the next place of each n-gram."""
    found: list[np.ndarray] = []
    at = np.arange(len(word))
    gram, n = word.astype(np.uint64), 1
    sizes = np.bincount(seg)
    end = np.cumsum(sizes)[seg] if len(seg) else seg          # of a place's segment
    while len(at):
        # n-gram hashes of the places whose n words lie in their segment, from two halves
        n *= 2
        fits = at + n <= end[at]
        # the second half's hash stands n / 2 further on: a segment's places are consecutive
        gram = mix64(gram[fits] * np.uint64(0x9E3779B97F4A7C15) + gram[np.flatnonzero(fits) + n // 2], n)
        at = at[fits]
        if n <= DIRECT:
            continue
        # a run of this octave, or a greater one, is longer than 1.5 n
        wide = sizes[seg[at]] > n + n // 2
        at, gram = at[wide], gram[wide]
        code = mix64(gram + seg[at].astype(np.uint64))
        order = np.argsort(code, kind="stable")
        ranked, back = code[order], at[order]
        again = ranked[1:] == ranked[:-1]
        i, lag = back[:-1][again], (back[1:] - back[:-1])[again]
        near = (lag > n // 2) & (lag <= n)
        i, lag = i[near], lag[near]
        by = np.argsort(i, kind="stable")
        i, lag = i[by], lag[by]
        a, b = _stretches(i, lag, seg[i])
        start, period = i[a], lag[a]
        length = b - a + n + period
        keep = length >= np.maximum(min_words, REPEATS * period)
        found.append(np.stack([start[keep], length[keep], period[keep]], axis=1))
    return found


def runs_of(word: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs, starts as places of ``word``, in order of start and period."""
    start, end = frequent_segments(word, first, min_words)
    if not len(start):
        return _NO_RUNS
    size = end - start
    seg = np.repeat(np.arange(len(start)), size)
    base = np.cumsum(size) - size
    at = np.arange(len(seg)) - np.repeat(base, size) + np.repeat(start, size)
    w = word[at]
    runs = np.concatenate(_direct_lags(w, seg, min_words) + _octave_lags(w, seg, min_words) + [_NO_RUNS])
    runs[:, 0] = at[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbers(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def _checked(runs: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray,
             min_words: int) -> np.ndarray:
    """The runs of a piece, those of a document with a false equality found anew."""
    if not len(runs):
        return runs
    doc = np.searchsorted(first, runs[:, 0], "right") - 1
    body = data.tobytes()
    out = []
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(runs)]):
        lo, hi = int(first[doc[a]]), int(first[doc[a] + 1])
        own = runs[a:b]
        x = [body[i:j] for i, j in zip(s[lo:hi].tolist(), e[lo:hi].tolist())]
        if not all(x[t - lo:t - lo + n - q] == x[t - lo + q:t - lo + n] for t, n, q in own.tolist()):
            own = runs_of(_numbers(x), np.array([0, hi - lo]), min_words) + np.array([lo, 0, 0])
        out.append(own)
    return np.concatenate(out)


def _joined(data: np.ndarray, offs: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray,
            keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each text, joined by one space."""
    mark = np.zeros(len(data) + 1, np.int8)
    mark[s[keep]] += 1
    mark[e[keep]] -= 1              # a word's end is never another word's start
    used = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    out = data.copy()
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    kept = np.flatnonzero(keep)
    more = kept[:-1][doc[kept[1:]] == doc[kept[:-1]]]      # kept words with another after them
    used[e[more]] = True
    out[e[more]] = 32
    upto = np.concatenate([[0], np.cumsum(used)])
    return out[used], upto[offs]


def _batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offs in pieces(batch.column(1)):
                s, e, first = word_spans(data, offs)
                _, word = np.unique(word_hashes(data, s, e), return_inverse=True)
                runs = _checked(runs_of(word, first, min_words), data, s, e, first, min_words)
                drop = np.zeros(len(s) + 1, np.int64)
                np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
                np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
                body, upto = _joined(data, offs, s, e, first, np.cumsum(drop[:-1]) == 0)
                doc = np.searchsorted(first, runs[:, 0], "right") - 1
                of = np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[doc]), pa.array(runs[:, 1]),
                                                    pa.array(runs[:, 2])], ["start", "length", "period"])
                text = pa.StringArray.from_buffers(b - a, pa.py_buffer(upto.astype(np.int32)),
                                                   pa.py_buffer(np.ascontiguousarray(body)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(of), found), text],
                    ["doc_id", "n_words", "runs", "text"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start and period, the collapsed text."""
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    return t.mapInArrow(_batches(min_words), SCHEMA)


def strongest(runs: str = "runs"):
    """The run of the greatest exact length / period; ties: the first by start and period. Null if none."""
    return F.aggregate(F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
                       .otherwise(best))
