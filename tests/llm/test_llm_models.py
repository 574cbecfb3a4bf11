"""Operators without a SQL form: libraries, exact round trips, brute force, held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from tessera.llm import lm_scoring, ngram_jaccard, packing, queries, sentencepiece_fst, toxicity

WORD_BPE = "/opt/tokenizers/word_bpe_49k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
ROWS = brute.messy(3)


@pytest.fixture(scope="module")
def docs(spark):
    made = [(d, t, 1, "x", 2, None) for d, t in ROWS]
    return spark.createDataFrame(made, "doc_id long, text string, k int, ids string, slot int, decoded string")


def odd_texts():
    r = random.Random(5)
    odd = ["".join(chr(r.choice([r.randrange(1, 300), r.randrange(1, 0xD7FF), 0x301, 0x3A3, 32, 10, 0x2003, 0x2581]))
                   for _ in range(60)) for _ in range(200)]
    return odd + ["a<|endoftext|>b <|startoftext|> Don't WE'LL x'S. A$$$ b.. c!?", "a" * 3000, "   ", "x  y   z ",
                  "    def f(x):\n        return x", "3.14159 https://a.b/c_d?e=1"] + [t or "" for _, t in ROWS]


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    texts = odd_texts()
    ids, upto = packing.WordEncoder(WORD_BPE).encode([t.encode() for t in texts])
    want = Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [e.ids for e in want]


def test_cuts_are_reciprocals_and_add_up():
    for n in range(0, 9000, 7):
        cuts = packing.reciprocal_cuts(n)
        assert sum(cuts) == n
        assert all(4096 // (4096 // c) == c for c in cuts)


def check_packing(pieces, texts, capacity=4096):
    """Each id of each row in one piece, sequences gapless and within capacity; the share of padding."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for d, t in texts:
        want[(d, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,))] += 1
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[(p["doc_id"], p["doc_tokens"])].append(p)
    for (d, ids), copies in want.items():
        ranges = defaultdict(int)
        for p in by_doc[(d, len(ids))]:
            part = np.array(ids[p["start"]:p["start"] + p["length"]], "<u4")
            if zlib.crc32(part.tobytes()) == p["ids_crc32"]:
                ranges[(p["start"], p["length"])] += 1
        assert sum(n for _, n in ranges) == len(ids)
        assert set(ranges.values()) == {copies}
    used = defaultdict(list)
    for p in pieces:
        used[p["sequence_id"]].append((p["offset"], p["length"]))
    total = 0
    for s in used.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
        total += at
    assert sorted(used) == list(range(len(used)))
    return 1 - total / max(1, len(used) * capacity)


def test_packing_messy(docs):
    check_packing(packing.pack(docs, WORD_BPE).collect(), ROWS)
    assert packing.pack(docs.limit(0), WORD_BPE).collect() == []


def test_packing_carries_ids(docs):
    for p in packing.pack(docs, WORD_BPE, keep_ids=True).collect():
        assert zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]


def test_packing_pads_little(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert check_packing(queries.QUERIES["op10_packing"](spark, SF_MID).collect(), texts) < 0.02


def test_transducer_equals_the_library():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts()
    t = sentencepiece_fst.Transducer(PIECES)
    ids, upto = t.encode(texts)
    want = sp.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == want
    flat = np.array([i for w in want for i in w], np.int64)
    ends = np.cumsum([0, *map(len, want)])
    assert t.decode(flat, ends) == [sp.decode(w) for w in want]


def test_encode_decode_round_trip(docs):
    both = sentencepiece_fst.decode(sentencepiece_fst.encode(docs, PIECES), PIECES)
    got = sorted(((r["doc_id"], r["decoded"]) for r in both.collect()), key=repr)
    assert got == sorted(((d, (t or "").replace("▁", " ")) for d, t in ROWS), key=repr)
    assert sentencepiece_fst.decode(sentencepiece_fst.encode(docs.limit(0), PIECES), PIECES).count() == 0


def test_lm_scores_against_brute_force(spark, docs):
    """With more cells than bigrams the hashed counts are the exact ones."""
    good_ids = {4, 9, 20, 21, 22, 25}
    counts = sorted(Counter(w for _, t in ROWS for w in brute.words(brute.lower(t or ""))).values(), reverse=True)
    size = next(n for n in range(60, len(counts)) if counts[n - 1] > counts[n])   # no tie at the vocabulary's edge
    good = spark.createDataFrame([(d,) for d in good_ids], "doc_id long")
    got = {}
    for r in lm_scoring.cross_entropy_difference(docs, good, vocabulary=size, cells=1 << 22).collect():
        got.setdefault((r["doc_id"], r["n_tokens"]), []).append(r["score"])
    texts = [(d, brute.words(brute.lower(t or ""))) for d, t in ROWS]
    count = Counter(w for _, ws in texts for w in ws)
    vocab = {w for w, _ in count.most_common(size)}
    models = []
    for target in (True, False):
        uni, left, pair = Counter(), Counter(), Counter()
        for d, ws in texts:
            if not target or d in good_ids:
                seq = ["<s>"] + [w if w in vocab else "<unk>" for w in ws]
                uni.update(seq[1:])
                left.update(seq[:-1])
                pair.update(zip(seq, seq[1:]))
        models.append((uni, left, pair, sum(uni.values())))
    for d, ws in texts:
        seq = ["<s>"] + [w if w in vocab else "<unk>" for w in ws]
        losses = []
        for uni, left, pair, n in models:
            loss = 0.0
            for v, w in zip(seq, seq[1:]):
                p = (uni[w] + 1) / (n + len(vocab) + 2)
                loss -= math.log((pair[v, w] + 16 * p) / (left[v] + 16))
            losses.append(loss / max(1, len(ws)))
        scores = got[(d, len(ws))]
        if ws:
            assert any(abs(s - (losses[0] - losses[1])) < 1e-9 for s in scores)
        else:
            assert set(scores) == {None}


def test_lm_counts_grow_with_the_input(spark):
    """At production parameters: 40,000 words are all in the vocabulary, and 1.2 M bigrams have counts of their own."""
    import random
    r = random.Random(5)
    names = [f"w{i}" for i in range(40_000)]
    texts = [(d, r.choices(names, k=600)) for d in range(2_000)]
    df = spark.createDataFrame([(d, " ".join(ws)) for d, ws in texts], "doc_id long, text string").repartition(4)
    good = spark.createDataFrame([(d,) for d in range(0, 2_000, 50)], "doc_id long")
    got = {s["doc_id"]: s for s in lm_scoring.cross_entropy_difference(df, good).collect()}
    assert len(got) == len(texts)
    count = Counter(w for _, ws in texts for w in ws)
    assert min(count.values()) > 1 and len(count) > 1 << 15
    for target, column in ((True, "target_loss"), (False, "background_loss")):
        uni, left, pair = Counter(), Counter(), Counter()
        for d, ws in texts:
            if not target or d % 50 == 0:
                uni.update(ws)
                left.update(["<s>"] + ws[:-1])
                pair.update(zip(["<s>"] + ws, ws))
        n = sum(uni.values())
        for d, ws in texts[::97]:
            loss = 0.0
            for v, w in zip(["<s>"] + ws, ws):
                loss -= math.log((pair[v, w] + 16 * (uni[w] + 1) / (n + len(count) + 2)) / (left[v] + 16))
            assert abs(got[d][column] - loss / len(ws)) < 1e-9


def test_lm_prefers_the_target(spark):
    s = queries.QUERIES["op4_lm_scoring"](spark, SF_MID)
    lab = spark.read.parquet(f"{SF_MID}/labels.parquet")
    m = {r["quality"]: r["m"] for r in s.join(lab, "doc_id").groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert m[1] < m[0]


def test_lm_empty(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_scoring.cross_entropy_difference(docs.limit(0), none).count() == 0
    assert lm_scoring.cross_entropy_difference(docs, none).count() == len(ROWS)


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    p = toxicity.toxicity(docs, lab.where("doc_id % 3 <> 0")).join(lab.where("doc_id % 3 = 0"), "doc_id")
    got = Counter((r["toxic"], r["p_toxic"] >= toxicity.THRESHOLD) for r in p.collect())
    assert got[(1, True)] / (got[(1, True)] + got[(1, False)]) > 0.85
    assert got[(0, True)] / (got[(0, True)] + got[(0, False)]) < 0.005


def test_later_models_see_out_of_fold_probabilities(spark):
    """A second category that equals the first one's chance is learnt through the chain."""
    made = [(i, ("bad " if i % 2 else "good ") + f"w{i}") for i in range(400)]
    lab = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)], "doc_id long, a int, b int")
    s = toxicity.labelled_sample(spark.createDataFrame(made, "doc_id long, text string"), lab, ("a", "b"))
    chain = toxicity.fit_chain(s, toxicity.choose_features(s, 2), 2)
    assert len(chain[1]) == len(chain[0]) + 1 and chain[1][-2] > 0.5


def test_toxicity_messy_and_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == len(ROWS) and max(r["p_toxic"] for r in got) < 1e-6
    lab = spark.createDataFrame([(4, 1, 0), (4, None, 1), (9, 0, 1), (None, 1, 1), (999, 1, 1)],
                                "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, lab).count() == len(ROWS)
    assert toxicity.toxicity(docs.limit(0), lab).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns

    def pairs(df):
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF_SMALL)
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    p = toxicity.toxicity(docs, lab)
    bad = {r["doc_id"] for r in p.collect() if r["p_toxic"] >= toxicity.THRESHOLD}
    assert bad and clean.columns == names
    assert pairs(clean) == [x for x in pairs(docs) if x[0] not in bad]
    clean = clean.persist()
    one = stages["exact_dedup"](spark, clean, SF_SMALL)
    kept = {r[0] for r in brute.exact(pairs(clean)) if r[3]}
    assert one.columns == names and pairs(one) == [x for x in pairs(clean) if x[0] in kept]
    one = one.persist()
    near = stages["ngram_jaccard"](spark, one, SF_SMALL)
    kept = {r[0] for r in brute.jaccard(pairs(one)) if r[0] == r[2]}
    assert near.columns == names and pairs(near) == [x for x in pairs(one) if x[0] in kept]
    near = near.persist()
    cut = stages["substring_dedup"](spark, near, SF_SMALL)
    assert cut.columns == names
    # a document that loses nothing keeps its text as it stands
    before = {d: brute.sha(t) for d, t in pairs(near)}
    want = {r[0]: r[3] if r[2] else before[r[0]] for r in brute.substrings(pairs(near))}
    assert {d: brute.sha(t) for d, t in pairs(cut)} == want
    other = [c for c in names if c not in ("text", "n_chars")]
    assert sorted(map(tuple, cut.select(*other).collect())) == sorted(map(tuple, near.select(*other).collect()))
    cut = cut.persist()
    check_packing(stages["packing"](spark, cut, SF_SMALL).collect(), pairs(cut))
    for df in (clean, one, near, cut):
        df.unpersist()


def test_near_copies_are_dropped_by_row(spark):
    """A text that occurs once stays, whatever other rows its doc_id has; so do texts without an id."""
    r = random.Random(4)
    a, b, c = (" ".join(f"w{r.randrange(5000)}" for _ in range(60)) for _ in range(3))
    found = [(1, a), (50, a + " end"), (50, b), (None, b + " more"), (None, c), (None, None), (None, ""), (7, "short")]
    docs = spark.createDataFrame([(*f, 1, "x") for f in found], "doc_id long, text string, _near_id int, `a.b` string")
    got = ngram_jaccard.drop_near_copies(docs)
    assert got.columns == docs.columns
    texts = sorted((r["doc_id"], r["text"]) for r in got.collect() if r["doc_id"] is not None)
    assert texts in ([(1, a), (7, "short"), (50, b)], [(1, a), (7, "short")])
    everything = {r["text"] for r in got.collect()}
    assert {a, c, "", None, "short"} <= everything and len(everything & {b, b + " more"}) == 1


def test_stages_take_any_column_names(spark):
    names = "doc_id long, text string, n_chars long, _row_id int, _row_raw int, `a.b` string, has_text string, _near_id int"
    w = " ".join(f"w{i}" for i in range(40))
    found = [(1, w, 5, 1, 2, "p", "q", 3), (2, "x\n" + w, 5, 1, 2, "p", "q", 3), (3, None, None, 1, 2, None, "q", 3),
             (4, "  kept \n as it is", 9, 1, 2, "p", None, 3), (5, w + " ", 5, 1, 2, "p", "q", 3)]
    docs = spark.createDataFrame(found, names)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["exact_dedup"](spark, docs, SF_SMALL)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == [2, 3, 4, 5]
    cut = stages["substring_dedup"](spark, docs, SF_SMALL)
    assert cut.columns == docs.columns
    got = {r["doc_id"]: tuple(r) for r in cut.collect()}
    assert got[1] == found[0] and got[3] == found[2] and got[4] == found[3]
    assert got[2] == (2, "x", 1, *found[1][3:]) and got[5][:3] == (5, "", 0)


def test_pipeline_stages_on_messy_and_empty_rows(spark, tmp_path):
    from pyspark.sql import types as T
    d = str(tmp_path)
    spark.createDataFrame([(4, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, extra int, p_toxic double"
    full = spark.createDataFrame([(i, t, None, None, None, "r", 1, .5) for i, t in ROWS], schema)
    for docs in (full, full.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, d).persist()
            assert [f.name for f in docs.schema] == [f.name for f in full.schema], name
            docs.count()
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, d).collect()
        check_packing(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert isinstance(full.schema, T.StructType)
