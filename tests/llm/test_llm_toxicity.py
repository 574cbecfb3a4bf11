"""Operator 9 against a plain chain: sets of words as strings, dense matrices, no hashing."""

import random

import numpy as np

from tessera.llm import toxicity

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def features(text):
    """The words of a text and their beginnings, as (length or None, bytes)."""
    out = set()
    for w in (text or "").encode().translate(LOWER).split():
        out.add((None, w))
        out.update((k, w[:k]) for k in toxicity.PREFIXES if len(w) > k)
    return out


def chosen(docs, y):
    """Features of at least 4 documents whose chi-square against any category is over 3.84."""
    n, out = len(docs), []
    for f in set().union(*docs):
        has = np.array([f in d for d in docs])
        best = 0.0
        for c in y.T:
            pos = c.sum()
            if 0 < pos < n and has.sum() >= 4:
                want = has.sum() * pos / n
                rest = has.sum() * (1 - pos / n)
                best = max(best, (c[has].sum() - want) ** 2 / want + (has.sum() - c[has].sum() - rest) ** 2 / rest)
        if best > 3.84:
            out.append(f)
    return out


def logistic(x, y, n_free, steps=400, ridge=0.5):
    """The same accelerated steps on a dense matrix; the last column is the intercept's."""
    w = np.zeros(x.shape[1])
    share = y.mean()
    if not 0 < share < 1:
        w[-1] = -40.0 if share == 0 else 40.0
        return w
    scale = (np.abs(x) * np.abs(x).sum(axis=1)[:, None]).sum(axis=0) / 4 + ridge
    free = np.append(np.ones(x.shape[1] - 1), 0.0)
    w[-1] = np.log(share / (1 - share))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        g = x.T @ (1 / (1 + np.exp(-np.clip(x @ v, -40, 40))) - y) + ridge * free * v
        new = v - g / scale
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    return w


def chain(texts, train, y, fold):
    """Probabilities of all texts by models fitted on the rows ``train``."""
    sets = [features(t) for t in texts]
    use = chosen([sets[i] for i in train], y)
    base = np.array([[f in s for f in use] for s in sets], float).reshape(len(texts), len(use))
    one = np.ones((len(texts), 1))
    seen, own = np.zeros((len(train), 0)), np.zeros((len(texts), 0))      # out of fold; by the full models
    for c in range(y.shape[1]):
        x = np.hstack([base[train], seen, one[:len(train)]])
        full = logistic(x, y[:, c], len(use))
        p = np.zeros(len(train))
        for f in range(toxicity.FOLDS):
            w = logistic(x[fold != f], y[fold != f, c], len(use))
            p[fold == f] = 1 / (1 + np.exp(-np.clip(x[fold == f] @ w, -40, 40)))
        z = np.hstack([base, own, one]) @ full
        own = np.column_stack([own, 1 / (1 + np.exp(-np.clip(z, -40, 40)))])
        seen = np.column_stack([seen, p])
    return own


def test_chain_against_a_plain_version(spark):
    r = random.Random(8)
    plain = [f"word{i}" for i in range(25)] + ["Éte", "a", "of"]
    bad, poor = ["vileness", "VILE", "vilest"], ["junk", "junkyard"]
    rows = []
    for d in range(160):
        toxic, low = r.random() < .3, r.random() < .4
        w = [r.choice(plain) for _ in range(r.randint(3, 20))]
        w += [r.choice(bad)] * (toxic and r.random() < .9) + [r.choice(poor)] * (low and r.random() < .8)
        r.shuffle(w)
        rows.append((d, " ".join(w) + r.choice(["", "\n", " \t"]), int(not low), int(toxic)))
    rows += [(900, None, 1, 0), (901, "", 0, 0), (902, "unlabelled vile text", None, None)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(d, q, t) for d, _, q, t in rows], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, labels, ("quality", "toxic"))
    fold = {x["doc_id"]: x["fold"] for x in sample.select("doc_id", "fold").collect()}
    train = [i for i, x in enumerate(rows) if x[2] is not None]
    y = np.array([[rows[i][2], rows[i][3]] for i in train], float)
    want = chain([x[1] for x in rows], train, y, np.array([fold[rows[i][0]] for i in train]))
    got = {x["doc_id"]: (x["p_quality"], x["p_toxic"]) for x in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) and set(fold.values()) == set(range(toxicity.FOLDS))
    for x, p in zip(rows, want):
        assert np.allclose(got[x[0]], p, atol=1e-6)
    assert got[902][1] > .5
