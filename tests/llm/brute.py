"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WS = " \t\n\x0b\x0c\r"
LAST = 1 << 62          # a null id stands after all others


def sha(x) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def key(doc_id):
    return LAST if doc_id is None else doc_id


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def lines(rows):
    first = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            k = lower(x.strip(WS))
            first[k] = min(first.get(k, LAST + 1), key(d))
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[lower(x.strip(WS))].add(d)
    out = []
    for d, t in rows:
        ls = (t or "").split("\n")
        keep = []
        for x in ls:
            k = lower(x.strip(WS))
            if len(k) < 10 or len(held[k]) < 2 or first[k] == key(d):
                keep.append(x)
        out.append((d, len(ls), len(ls) - len(keep), sha("\n".join(keep))))
    return out


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups["".join(c for c in t or "" if c not in WS)].append((-len(t or ""), key(d), d))
    out = []
    for d, t in rows:
        n = "".join(c for c in t or "" if c not in WS)
        best = min(groups[n], key=lambda g: g[:2])
        out.append((d, best[2], len(groups[n]), (-len(t or ""), key(d)) == best[:2], sha(n)))
    return out


def substrings(rows, k=13):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            first[g] = min(first.get(g, LAST + 1), key(d))
    out = []
    for d, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < key(d):
                keep[i:i + k] = [False] * k
        kept = [x for x, y in zip(w, keep) if y]
        out.append((d, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def quality(rows):
    out = []
    for d, t in rows:
        t = t or ""
        w = words(t)
        g = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {i + j for i in range(len(w) - 4) if g[tuple(w[i:i + 5])] > 1 for j in range(5)}
        full = [x for x in t.split("\n") if x.strip(WS)]
        n, rep = len(w), len(cover)
        out.append((d, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), rep,
                    n < 10 or 100 * rep > 20 * n))
    return out


def jaccard(rows):
    sets, texts = {}, defaultdict(set)
    n_of = []
    for r, (d, t) in enumerate(rows):
        w = words(lower(t or ""))
        s = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[r] = s
        n_of.append(len(s))
        for x in s:
            texts[x].add(r)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by_id = {}
    for r, (d, _) in enumerate(rows):
        if sets[r]:
            parent[find(r)] = find(by_id.setdefault(d, r))
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    least = {}
    for r, (d, _) in enumerate(rows):
        least[find(r)] = min(least.get(find(r), LAST + 1), key(d))
    return [(d, n_of[r], None if least[find(r)] == LAST else least[find(r)]) for r, (d, _) in enumerate(rows)]


def suffixes(rows, n=200):
    count = Counter()
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        count.update(b[i:i + n] for i in range(len(b) - n + 1))
    out = []
    for (d, _), b in zip(rows, data):
        keep = bytearray(b"\x01" * len(b))
        for i in range(len(b) - n + 1):
            if count[b[i:i + n]] > 1:
                keep[i:i + n] = bytes(n)
        spans = sum(1 for i in range(len(b)) if not keep[i] and (i == 0 or keep[i - 1]))
        out.append((d, len(b), len(b) - sum(keep), spans, sha(bytes(x for x, k in zip(b, keep) if k))))
    return out


def runs(w, least=24, times=3):
    """(start, length, period) of every maximal run of smallest period, by trying all."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                own = w[i:i + length]
                if not any(own[k:] == own[:-k] for k in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rows, plant=lambda d, w: w):
    out = []
    for d, t in rows:
        w = plant(d, words(t))
        found = runs(w)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
        out.append((d, len(found), *best, None if not found else 1000 * best[1] // best[2],
                    sha("".join("%d,%d,%d\n" % r for r in found)), sha(collapsed(w, found))))
    return out


def planted(d, w):
    """Words of document d as op12_periodic_runs reads them."""
    h = 1 if d is None else zlib.crc32(str(d).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def ordered(rows):
    """Conversations of (conv_id, turn, role, text) rows as lists of (role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        v = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += v
    out = []
    for p, m in members.items():
        ends = sha(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], ends))
    return sorted(out, key=repr)


def messy(seed=7):
    """(doc_id, text) rows with nulls, empties, ties, repeats, near copies, long and odd texts."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgéñöABC.,$") for _ in range(r.randint(1, 8))) for _ in range(150)]

    def text(n):
        return "".join(r.choice(vocab) + r.choice([" ", " ", " ", "\n", "\t", "  ", " \n "]) for _ in range(n))
    base = [text(r.randint(20, 120)) for _ in range(12)]
    passage = text(60)
    rows = [(0, None), (1, ""), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, "x"),
            (7, "short line\nshort line\nshort LINE "), (8, "another\nshort line"), (9, text(6000)),
            (10, "　wide space\x1cunit \x85next"), (11, "a " * 400), (12, "ab" * 500), (13, "😀" * 300)]
    n = 20
    for b in base:
        rows.append((n, b))
        for _ in range(r.randint(0, 3)):
            n += 1
            kind = r.random()
            if kind < .3:
                rows.append((n, b))
            elif kind < .5:
                rows.append((n, b.replace(" ", "  ")))
            elif kind < .8:
                w = b.split(" ")
                w[r.randrange(len(w))] = "changed"
                rows.append((n, " ".join(w)))
            else:
                rows.append((n, text(20) + passage + text(20)))
        n += 1
    rows += [(n, base[0]), (n, base[0]), (None, base[1]), (n + 1, passage), (n + 2, passage + passage)]
    r.shuffle(rows)
    return rows
