"""Word and n-gram hashes of many texts at once, with numpy on the UTF-8 bytes.

Words are ``[^\\x20\\x09-\\x0D]+``. All bytes of these separators are ASCII, so
they are found on the bytes without decoding. A word's hash is a polynomial
over its bytes modulo 2**64, taken from running sums, then mixed; an n-gram's
hash is a polynomial over its word hashes, mixed again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
#: Odd and 5 modulo 8, so its powers are far apart modulo 2**64; the inverse serves to shift a sum to a word's start.
_BASE = 0x9E3779B97F4A7C1D
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text worked on at once (a longer text is a piece of its own).
PIECE = 1 << 20


def mix64(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer: every bit of the result depends on every bit of ``h`` and the seed."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of a base modulo 2**64, remembered per process and left out of pickles."""

    def __init__(self):
        self.memo: dict[int, np.ndarray] = {}

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, base: int, n: int) -> np.ndarray:
        p = self.memo.get(base)
        if p is None or len(p) < n:
            size = max(n, 1 << 16)
            p = np.ones(size, np.uint64)
            done = 1
            while done < size:
                step = min(done, size - done)
                p[done:done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
                done += step
            if size <= 4 * PIECE:
                self.memo[base] = p
        return p[:n]


_powers = _Powers()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: none) and the offsets of its rows."""
    t = texts.cast(pa.large_string()).fill_null("")
    if t.offset or len(t) == 0:
        t = pa.concat_arrays([t, pa.array([], pa.large_string())])
    if len(t) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(t.buffers()[1], np.int64)[t.offset:t.offset + len(t) + 1]
    body = t.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): runs of whole texts of about ``size`` bytes."""
    data, offs = text_bytes(texts)
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield at, to, data[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
        at = to


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text its first word (and the end)."""
    n = len(data)
    inner = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True                       # no word crosses a text's bounds
    start = inner.copy()
    start[1:] &= ~inner[:-1] | edge[1:n]
    end = inner.copy()
    end[:-1] &= ~inner[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def byte_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running sums from which ``span_hashes`` takes the hash of any span; A-Z count as a-z if ``lower``."""
    return running_sums((_UPPER[data] if lower else data).astype(np.uint64) + np.uint64(1))


def running_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of values times the powers of the base."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, s: np.ndarray, e: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per span of bytes."""
    if not len(s):
        return np.zeros(0, np.uint64)
    h = (sums[e] - sums[s]) * _powers(_INVERSE, len(sums))[s]
    return mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), seed)


def gram_hashes(sums: np.ndarray, m: int, seed: int = 0) -> np.ndarray:
    """Hash of the m bytes that start at each place (as ``span_hashes`` would give)."""
    n = len(sums) - m
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = (sums[m:] - sums[:n]) * _powers(_INVERSE, n)
    return mix64(h + np.uint64(m * 0xD6E8FEB86659FD93 & (1 << 64) - 1), seed)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = False,
                seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word."""
    return span_hashes(byte_sums(data, lower), s, e, seed)


def ngram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of words[i : i + n] for each i; the last n - 1 places are not windows of one run."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h *= np.uint64(_BASE)
        h += words[j:j + m]
    return mix64(h, seed + 1)


def window_places(first: np.ndarray, n: int) -> np.ndarray:
    """Word places at which a window of n words lies within one text."""
    lens = np.maximum(np.diff(first) - n + 1, 0)
    upto = np.cumsum(lens)
    return np.repeat(first[:-1] - (upto - lens), lens) + np.arange(upto[-1] if len(upto) else 0)
