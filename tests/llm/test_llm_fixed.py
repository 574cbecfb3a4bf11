"""Operators whose result is fixed: DuckDB on the small table, brute force on a messy one."""

import brute
import pytest
from conftest import SF_MID, SF_SMALL
from oracle_check import compare, duck_connection
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, line_dedup, ngram_jaccard, quality_rules, queries, substring_dedup, suffix_dedup

ROWS = brute.messy()
SCHEMA = ("doc_id long, text string, kept string, row int, h long, chunk string, t double, n int, words string, "
          "node int, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def docs(spark):
    """The messy rows; the other columns are null or bear the operators' own names."""
    return spark.createDataFrame([(d, t, "x", None, 1, None, .5, 2, "w", 3, None, None, None) for d, t in ROWS],
                                 SCHEMA).repartition(5)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def lines(docs):
    k = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return rows(k, "doc_id", "n_lines", "n_dropped", F.sha2("text", 256))


def exact(docs):
    return rows(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))


def substrings(docs):
    k = substring_dedup.dedup_substrings(docs)
    return rows(k, "doc_id", "n_words", "n_removed", F.sha2("text", 256))


def quality(docs):
    led = quality_rules.quality_ledger(docs)
    return rows(led, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                quality_rules.fails("base-v1"))


def jaccard(docs):
    return rows(ngram_jaccard.jaccard_components(docs), "doc_id", "n", "component_id")


def suffixes(docs):
    k = suffix_dedup.dedup_suffixes(docs)
    return rows(k, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))


PAIRS = {"lines": lines, "exact": exact, "substrings": substrings, "quality": quality, "jaccard": jaccard,
         "suffixes": suffixes}


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_messy_rows_against_brute_force(docs, name):
    assert PAIRS[name](docs) == sorted(getattr(brute, name)(ROWS), key=repr)


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_empty_table(docs, name):
    assert PAIRS[name](docs.limit(0)) == []


def test_suffixes_of_a_hot_anchor_by_window_hashes(docs):
    k = suffix_dedup.dedup_suffixes(docs, hot=1)
    got = rows(k, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert got == sorted(brute.suffixes(ROWS), key=repr)


def test_substrings_of_a_source_with_several_rows(spark):
    x = [f"x{i}" for i in range(1, 15)]
    found = [(5, " ".join([*x[:13], "zzz"])), (5, " ".join(["y", *x[1:]])), (9, " ".join(x)), (None, " ".join(x)),
             (None, "q " + " ".join(x))]
    df = spark.createDataFrame(found, "doc_id long, text string")
    got = rows(substring_dedup.dedup_substrings(df), "doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert got == sorted(brute.substrings(found), key=repr) and (9, 14, 14) in [g[:3] for g in got]


def odd_bytes(seed):
    """Texts of few symbols, NUL and the highest code point among them, that repeat by parts."""
    r = __import__("random").Random(seed)
    symbols = r.choice([["\0", "a"], ["\0", "\0", "\0", "b"], ["\U0010ffff", "\0"], ["\xff", "a", "\0"]])
    whole = "".join(r.choice(symbols) for _ in range(200)) + "\0" * 60
    out = []
    for i in range(40):
        a = r.randrange(len(whole))
        out.append((i, "".join(r.choice(symbols) * r.randint(1, 9) for _ in range(r.randint(0, 12)))
                    + whole[a:a + r.randint(0, 70)] + "\0" * r.choice([0, 0, 5, 30])))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
@pytest.mark.parametrize("length,anchor", [(20, 4), (48, 11)])
def test_suffixes_with_nul_and_highest_bytes(spark, length, anchor, hot):
    for seed in range(4):
        found = odd_bytes(seed)
        df = spark.createDataFrame(found, "doc_id long, text string").repartition(3)
        k = suffix_dedup.dedup_suffixes(df, length=length, anchor=anchor, hot=hot)
        got = rows(k, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        assert got == sorted(brute.suffixes(found, length), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_oracle_parity(spark, name):
    sf = SF_MID if name in ("op2_exact_dedup", "op1_line_dedup") else SF_SMALL
    ok, msg = compare(name, queries.QUERIES[name](spark, sf), duck_connection(sf), queries.SQL[name])
    assert ok, msg


def test_many_near_copies_form_one_component(spark):
    """Copies that differ in other words each: linked by chains, not all pairwise."""
    base = [f"w{i}" for i in range(200)]
    made = []
    for d in range(60):
        w = list(base)
        for i in range(2):
            w[(d * 7 + i * 90) % 200] = f"x{d}_{i}"
        made.append((d, " ".join(w)))
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(made, "doc_id long, text string"))
    assert rows(got, "doc_id", "n", "component_id") == sorted(brute.jaccard(made), key=repr)


def test_a_document_with_three_texts_is_one_component(spark):
    texts = {d: " ".join(f"t{d}w{i}" for i in range(30)) for d in range(1, 6)}
    made = [*texts.items(), *((50, texts[d]) for d in (1, 2, 3)), (60, texts[4])]
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(made, "doc_id long, text string"))
    assert rows(got, "doc_id", "n", "component_id") == sorted(brute.jaccard(made), key=repr)


def check_links(made, df):
    """Every pair of rows is compared, and no link of two documents may be missing."""
    def shingles(t):
        w = brute.words(brute.lower(t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    def linked(a, b):
        return bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    sets = [(d, shingles(t)) for d, t in made]
    node = {}
    for d, s in sets:
        node[s] = min(node.get(s, brute.LAST + 1), brute.key(d))
    want = [(*row, len({e for e, x in sets if linked(s, x)} - {d})) for row, (d, s) in zip(brute.jaccard(made), sets)]
    pairs = {(node[a], node[b]) for a in node for b in node if node[a] < node[b] and linked(a, b)}
    documents, members, links = ngram_jaccard.jaccard_links(df)
    assert rows(documents, "doc_id", "n", "component_id", "n_links") == sorted(want, key=repr)
    real = lambda i: brute.LAST if i == ngram_jaccard.NULL_ID else i
    assert sorted((real(r["a"]), real(r["b"])) for r in links.collect()) == sorted(pairs)
    assert ({(real(r["doc_id"]), real(r["node"])) for r in members.collect()}
            == {(brute.key(d), node[s]) for d, s in sets if s})


def test_links_within_a_component_are_given(spark):
    base = [f"w{i}" for i in range(200)]
    made = [(d, " ".join("x" + str(d) if i in (d * 3, 199 - d) else w for i, w in enumerate(base))) for d in range(25)]
    made += [(30, made[4][1]), (31, made[4][1]), (40, made[5][1]), (40, made[6][1]), (40, "else where"), (41, None)]
    check_links(made, spark.createDataFrame(made, "doc_id long, text string").repartition(3))


def test_exact_copies_are_dropped_by_row(spark):
    """One row of each text stays, whatever ids repeat or are null."""
    made = [(1, "a copy"), (50, "a copy"), (50, "only here"), (2, "twice"), (2, "twice"), (None, "a  copy"),
            (None, "no id"), (None, "no id"), (3, "s p"), (3, "sp "), (4, None), (4, ""), (5, "alone")]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = rows(exact_dedup.drop_exact_copies(df), "doc_id", "text")
    norm = [brute.exact([r])[0][4] for r in got]
    assert len(norm) == len(set(norm)) == len({r[4] for r in brute.exact(made)})
    assert {(None, "a  copy"), (50, "only here"), (2, "twice"), (None, "no id"), (5, "alone")} <= set(got) <= set(made)


def test_a_line_that_every_document_holds(spark):
    """The run of one key spans many range partitions."""
    made = [(d, f"the line that all hold\nown line number {d}\nthe LINE that all hold") for d in range(500)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(7)
    assert lines(df) == sorted(brute.lines(made), key=repr)


def test_policies_and_ablations(docs):
    led = quality_rules.quality_ledger(docs).persist()
    masks = [r["failed"] for r in led.collect()]
    for policy, p in quality_rules.POLICIES.items():
        kept = quality_rules.apply_policy(led, policy).where("kept").count()
        assert kept == sum(m & p == 0 for m in masks)
        names = list(quality_rules.RULES)
        for r in quality_rules.ablations(led, policy).collect():
            bit = 1 << names.index(r["rule"])
            assert r["n_failed"] == sum(bool(m & bit) for m in masks)
            assert r["n_only"] == sum(m & p == bit for m in masks)
            assert r["n_kept_without"] == sum(m & p & ~bit == 0 for m in masks)
    led.unpersist()


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op6_quality_rules"])
def test_native_operators_have_no_python_in_their_plans(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_parting_the_subpackage_leaves_the_entry():
    """Nothing outside the subpackage imports it."""
    import pathlib
    root = pathlib.Path(queries.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "llm" not in f.read_text(), f
