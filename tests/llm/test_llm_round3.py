"""Operators 11 to 13 against plain versions."""

import random

import brute
import pytest
from conftest import SF_MID, SF_SMALL
from oracle_check import compare, duck_connection
from pyspark.sql import functions as F

from tessera.llm import prefix_trie as trie_module
from tessera.llm import queries
from tessera.llm.common import read_table
from tessera.llm.periodic_runs import periodic_runs
from tessera.llm.prefix_trie import conversation_trie, prefix_trie
from tessera.llm.scans import group_scan
from tessera.llm.token_counts import count_huge, token_counts

ROWS = brute.messy()
SCHEMA = "doc_id long, text string, start long, runs string, `a.b` int, key string, t double, n int, no long"


@pytest.fixture(scope="module")
def docs(spark):
    """The messy rows; the other columns bear the operators' own names."""
    return spark.createDataFrame([(d, t, 1, "x", 2, "k", .5, 2, 3) for d, t in ROWS], SCHEMA).repartition(5)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def read(spark, name):
    return [tuple(r) for r in read_table(spark, SF_SMALL, name).collect()]


# ---- op11

def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))


def plain_counts(pairs):
    tk = library()
    return sorted(((d, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids))
                   for d, t in pairs), key=repr)


def odd_texts():
    r = random.Random(3)
    marks = ["<|endoftext|>", "<|startoftext|>", "don't", "é", "İ", "Σας", "　", "\x85", "字" * 30, "12345", "!'s", "\n\n",
             "ABC", "naïve", "가", "x" * 50]
    out = [(i, "".join(r.choice(marks) + r.choice(["", " ", " ", "  "]) for _ in range(r.randint(50, 400))))
           for i in range(12)]
    return [*out, (50, "字" * 3000), (51, "a" * 3000), (52, " " * 3000), (53, "<|endoftext|>" * 200), (53, "a b " * 900),
            (53, "a b " * 900), (None, "word " * 700), (54, "x" * 700 + " y " + "z" * 1500)]


def test_token_counts_equal_the_library(docs):
    path = queries.tokenizer_file("word_bpe_49k.json")
    assert rows(token_counts(docs, path), "doc_id", "n_bytes", "n_tokens") == plain_counts(ROWS)


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (300, 40), (1000, 200)])
def test_chunks_are_spliced_where_they_agree(spark, chunk, overlap):
    pairs = odd_texts() + ROWS
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = token_counts(df, queries.tokenizer_file("word_bpe_49k.json"), huge=100, chunk=chunk, overlap=overlap)
    assert rows(got, "doc_id", "n_bytes", "n_tokens") == plain_counts(pairs)


def test_a_text_without_white_space_widens_to_one_chunk(spark):
    df = spark.createDataFrame([("k", "字" * 500 + "q" * 500)], "key string, t string")
    got = count_huge(df, queries.tokenizer_file("word_bpe_49k.json"), chunk=50, overlap=10)
    want = len(library().encode("字" * 500 + "q" * 500, add_special_tokens=False).ids)
    assert rows(got, "key", "n_tokens") == [("k", want)]


def test_token_counts_of_an_empty_table(docs):
    assert rows(token_counts(docs.limit(0), queries.tokenizer_file("word_bpe_49k.json")), "doc_id") == []


def test_op11_query(spark):
    got = rows(queries.op11_token_counts(spark, SF_SMALL), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = plain_counts([(r[0], r[1]) for r in read(spark, "documents")])
    assert got == [(*w, w[2] > 2048) for w in want]


# ---- op12

OP12 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def repeated_texts():
    r = random.Random(5)
    out = []
    for i in range(60):
        v = [chr(97 + k) for k in range(r.choice([1, 2, 3, 8]))]
        w = []
        for _ in range(r.randint(0, 5)):
            if r.random() < .6:
                p = [r.choice([*v, "x", "y", "zé"]) for _ in range(r.choice([1, 2, 3, 5, 8, 9, 16, 17, 31, 33, 40]))]
                w += (p * 8)[:r.randint(int(2.5 * len(p)), 6 * len(p) + 3)]
            else:
                w += [r.choice(v) for _ in range(r.randint(0, 60))]
        out.append((i, r.choice(["", " "]) + "".join(x + r.choice([" ", "\n", "  \t"]) for x in w)))
    return out


def as_op12(found):
    """The query's digests of an operator's result."""
    return rows(queries.run_digests(found), *OP12)


def test_runs_of_messy_and_repeated_texts(spark, docs):
    assert as_op12(periodic_runs(docs)) == sorted(brute.periodic(ROWS), key=repr)
    pairs = repeated_texts()
    got = as_op12(periodic_runs(spark.createDataFrame(pairs, "doc_id long, text string")))
    assert got == sorted(brute.periodic(pairs), key=repr) and sum(r[1] > 1 for r in got) > 10


def test_no_runs_in_an_empty_table(docs):
    assert rows(periodic_runs(docs.limit(0)), "doc_id") == []


def test_false_equality_of_hashes_is_found(spark, monkeypatch):
    """With all words equal by hash, the check by bytes still gives the right runs."""
    import numpy as np

    from tessera.llm import periodic_runs as m
    monkeypatch.setattr(m, "word_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    pairs = repeated_texts()[:20]
    texts = spark.createDataFrame(pairs, "doc_id long, text string")
    assert as_op12(periodic_runs(texts)) == sorted(brute.periodic(pairs), key=repr)


def test_op12_query(spark):
    pairs = [(r[0], r[1]) for r in read(spark, "documents") if len(r[1] or "") < 4000]
    ids = {p[0] for p in pairs}
    got = queries.op12_periodic_runs(spark, SF_SMALL)
    got = [r for r in rows(got, *OP12) if r[0] in ids]
    assert got == sorted(brute.periodic(pairs, brute.planted), key=repr) and sum(r[1] > 0 for r in got) > 5


# ---- op13

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(seed=11, n=60):
    """Shared beginnings, copies, null and repeated turns, null role or text, one very long conversation, gaps in ids."""
    r = random.Random(seed)
    texts = ["hello", "hé", "", None, "ok", "a longer turn of text", "字"]
    out = []
    for c in range(n):
        if r.random() < .15:
            continue
        kind = r.random()
        size = 0 if kind < .05 else r.randint(1, 12)
        for i in range(size):
            same = kind < .5 and i < 4
            out.append((c, i, "user" if i % 2 else None, "shared %d" % i if same else r.choice(texts)))
        if kind > .8:
            out.append((c, None, "system", r.choice(texts)))
        if kind > .9:
            out += [(c, 1, "user", "again"), (c, 1, "user", "again")]
    out += [(n + 2, i, "user", "long %d" % (i % 7)) for i in range(500)]
    out += [(n + 3, i, "user", "long %d" % (i % 7)) for i in range(300)]
    out += [(-7, 0, "user", "hello"), (None, 0, "user", "nobody"), (1 << 40, 0, None, None)]
    r.shuffle(out)
    return out


def conv_frame(spark, found):
    schema = "conv_id long, turn int, role string, text string, depth int, key string, place string, `a.b` int, _pid int"
    return spark.createDataFrame([(*x, 1, "k", "p", 2, 3) for x in found], schema)


def test_trie_against_brute_force(spark, monkeypatch):
    found = conversations()
    monkeypatch.setattr(trie_module, "CONVERSATIONS", 8)
    for depths in (64, 3):
        monkeypatch.setattr(trie_module, "DEPTHS", depths)
        df = conv_frame(spark, found).repartition(7)
        assert rows(conversation_trie(df), *TRIE) == brute.trie(brute.ordered(found))
    assert rows(prefix_trie(*queries.rebuilt(df)), *TRIE) == brute.trie(brute.rebuilt(brute.ordered(found)))


def test_trie_of_no_conversations(spark):
    df = conv_frame(spark, [(None, 0, "user", "nobody")])
    assert rows(conversation_trie(df), *TRIE) == [] == rows(conversation_trie(df.limit(0)), *TRIE)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_op13_query(spark, sf):
    ok, msg = compare("op13_prefix_trie", queries.op13_prefix_trie(spark, sf), duck_connection(sf),
                      queries.SQL["op13_prefix_trie"])
    assert ok, msg
    want = brute.trie(brute.rebuilt(brute.ordered([tuple(r) for r in read_table(spark, sf, "conversations").collect()])))
    assert rows(queries.op13_prefix_trie(spark, sf), *TRIE) == want


def test_scan_of_a_group_over_many_partitions(spark):
    r = random.Random(2)
    found = [(0 if i % 2 else i // 40, i, r.randint(-9, 9), r.getrandbits(62)) for i in range(2000)]
    df = spark.createDataFrame(found, "g long, i long, v long, x long").repartition(5)
    out = group_scan(df, "g", ["i"], ["v"], ["x"])
    got = rows(out, "g", "i", "n", "ordinal", "last", "cum_v", "cum_x")
    want, seen = [], {}
    groups = sorted({f[0] for f in found})
    size = {g: sum(f[0] == g for f in found) for g in groups}
    for g, i, v, x in sorted(found):
        n, s, y = seen.get(g, (0, 0, 0))
        seen[g] = n, s, y = n + 1, s + v, y ^ x
        want.append((g, i, n, groups.index(g), n == size[g], s, y))
    assert got == sorted(want, key=repr)
