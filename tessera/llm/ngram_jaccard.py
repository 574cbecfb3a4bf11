"""Operator 7, n-gram Jaccard join: prefix filter in blocks with size bounds, exact verification.

The matrix is documents by 5-word shingles. Two documents link when
``100 * |A & B| >= 80 * |A | B|``; the answer is each document's component.

1. Equal sets. Documents with the same shingle set are one node from step 3 on
   (they link by definition); its id is their smallest doc_id.
2. Column counts in blocks (``blocks``: each block owns a range of shingles).
   First over the least hashes of every document only, then, for the
   documents left, over all their shingles. A document needs ``ceil(0.8 n)``
   shingles that other documents hold as well; size bounds drop the rest.
3. Row prefixes. In a global order (rarest first, counts from step 2) a linked
   pair shares one of the first ``n - ceil(0.8 n) + 1`` shingles of either side,
   at places that leave enough shingles behind them (positional bound). These
   few entries are the blocks' columns.
4. Pairs. In each column the pairs of entries that the size and positional
   bounds allow are candidates, and whether they link is decided exactly on
   the whole sets; no overlap is accumulated. Near copies would give the square
   of their number of pairs, so the components are found in rounds. In round t
   each entry is tried with up to 4 ** t entries of its column, picked anew by
   hash, that are of other components. Components that link become one, and
   columns within one component are closed, so there are ever fewer entries to
   try with more picks. Rounds go on until one finds no link. Then every pair that is left
   between different components is tried, each in the first column that it
   shares, so no link between components is lost; these are hardly more than the pairs of
   components that share columns without linking. ``jaccard_links``
   takes the pairs within components too.

Pairs are made by joins on a column that AQE may split; no column is gathered
in one task.

Defined results: null or empty texts have the empty set, link with nothing
and are their own component; fewer than five words are one shingle; rows that
repeat a doc_id are one document, hence one component; a null doc_id is larger
than all others (and null again in the result); an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (NULL_ID, PACKED, block_count, chunked, find, joined, per_block, per_chunk,
                     to_blocks, with_replies)
from .common import quoted, staged, unstage, unused, without
from .words import ngram_hashes, pieces, window_places, word_hashes, word_spans

N = 5
PERCENT = 80

_SETS = ("doc_id long, n long, digest binary, shingles array<long>, columns array<long>, "
         "places array<int>")


def least_shared(n, percent: int = PERCENT):
    """Shingles that a set of n must share with a set that it links with."""
    return -(-percent * n // 100)


def _sets(table: pa.Table, n: int):
    """Per piece of a chunk: (rows at..to, row of each shingle, shingle), sorted and distinct per row."""
    for at, to, data, offs in pieces(table["t"].combine_chunks()):
        s, e, first = word_spans(data, offs)
        w = word_hashes(data, s, e, lower=True)
        p = window_places(first, n)
        words = np.diff(first)
        row = np.repeat(np.arange(len(words)), np.maximum(words - n + 1, 0))
        h = ngram_hashes(w, n)[p] if len(p) else np.zeros(0, np.uint64)
        short = np.flatnonzero((words > 0) & (words < n))
        if len(short):
            own = np.array([ngram_hashes(w[first[i]:first[i + 1]], words[i])[0] for i in short], np.uint64)
            h, row = np.concatenate([h, own]), np.concatenate([row, short])
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        yield at, to, row[new], h[new]


def _digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _bounds(row: np.ndarray, rows: int):
    n = np.bincount(row, minlength=rows)
    upto = np.concatenate([[0], np.cumsum(n)])
    return n, upto, np.arange(len(row)) - upto[row]


def _counts(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    h, c = np.unique(h, return_counts=True)
    return h, c.astype(np.uint32)


def _sample_length(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a set of n, the length of the sample of least hashes, and how many of it must be shared.

    Two linked sets share at least l of their samples if either sample is l
    longer than the shingles its set may keep to itself, n - least_shared(n).
    Samples are that number again longer; the smallest partner's decides.
    """
    def longer(x):
        return np.maximum(1, x - least_shared(x, percent))
    return n - least_shared(n, percent) + longer(n), longer(least_shared(n, percent))


def _send_samples(n: int, percent: int, n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        seen: set[bytes] = set()
        parts = []
        for at, to, row, h in _sets(table, n):
            size, upto, rank = _bounds(row, to - at)
            fresh = np.zeros(to - at, bool)
            for i in np.flatnonzero(size):         # equal sets of a chunk count once
                d = _digest(h[upto[i]:upto[i + 1]])
                fresh[i] = d not in seen
                seen.add(d)
            q, _ = _sample_length(size, percent)
            parts.append(h[(rank < q[row]) & fresh[row]])
        hashes, count = _counts(parts)
        return to_blocks(table["chunk"][0].as_py(), n_blocks, hashes, [count])
    return run


def _shared(first: np.ndarray, run_of: np.ndarray, cols: list[np.ndarray]):
    total = np.add.reduceat(cols[0].astype(np.int64), first)
    return (total > 1)[run_of], [np.minimum(total, (1 << 32) - 1).astype(np.uint32)[run_of]]


def _send_all(n: int, percent: int, n_blocks: int):
    """All shingles of the documents whose sample is shared enough."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return to_blocks(0, n_blocks, np.zeros(0, np.uint64), [])
        shared, _ = joined(replies, [np.uint32])
        own, seen = [], set()
        for at, to, row, h in _sets(table, n):
            size, upto, rank = _bounds(row, to - at)
            q, must = _sample_length(size, percent)
            hit, _ = find(h, shared)
            got = np.bincount(row[hit & (rank < q[row])], minlength=to - at)
            stays = (got >= must) & (size > 0)
            for i in np.flatnonzero(stays):
                d = _digest(h[upto[i]:upto[i + 1]])
                stays[i] = d not in seen
                seen.add(d)
            own.append(h[stays[row]])
        hashes, count = _counts(own)
        return to_blocks(table["chunk"][0].as_py(), n_blocks, hashes, [count])
    return run


def _documents(n: int, percent: int):
    """Per document its size and digest; for those that may link, the set and its prefix columns."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        shared, df = joined(replies, [np.uint32])
        ids = table["doc_id"].to_numpy() if table.num_rows else np.zeros(0, np.int64)
        sizes, digests, sets, columns, places = [], [], [], [], []
        for at, to, row, h in _sets(table, n):
            size, upto, _ = _bounds(row, to - at)
            hit, where = find(h, shared)
            count = np.where(hit, df[where] if len(df) else 0, 1)
            need = least_shared(size, percent)
            may = (np.bincount(row[count > 1], minlength=to - at) >= need) & (size > 0)
            for i in range(to - at):
                a, b = upto[i], upto[i + 1]
                own = h[a:b]
                sizes.append(int(size[i]))
                digests.append(_digest(own))
                if not may[i]:
                    sets.append(None)
                    columns.append(None)
                    places.append(None)
                    continue
                rare = np.lexsort((own, count[a:b]))[:size[i] - need[i] + 1]
                at_ = np.flatnonzero(count[a:b][rare] > 1)
                sets.append(own.view(np.int64))
                columns.append(own[rare[at_]].view(np.int64))
                places.append(at_.astype(np.int32))
        return pa.table({"doc_id": pa.array(ids), "n": pa.array(sizes, pa.int64()),
                         "digest": pa.array(digests, pa.binary()),
                         "shingles": pa.array(sets, pa.list_(pa.int64())),
                         "columns": pa.array(columns, pa.list_(pa.int64())),
                         "places": pa.array(places, pa.list_(pa.int32()))})
    return run


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                 percent: int = PERCENT) -> DataFrame:
    """Steps 1 and 2, written: one row per document (``_SETS``)."""
    blocks = block_count(docs, text_col)
    t = chunked(docs, blocks, id_col, text_col, by_row=True)
    some = per_block(per_chunk(t, _send_samples(n, percent, blocks), PACKED), [np.uint32], _shared)
    all_ = per_block(with_replies(t, some, _send_all(n, percent, blocks), PACKED), [np.uint32], _shared)
    return staged(with_replies(t, all_, _documents(n, percent), _SETS), "shingle-sets")


def _min_labels(edges: DataFrame) -> DataFrame:
    """(node, comp) of each node on an edge: the least node of its component.

    Labels pass along the edges and are then looked up once more (pointer
    jumping), so the number of rounds follows the logarithm of a component's
    width. Each round is written, so it costs no recomputation.
    """
    both = staged(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = staged(both.select(F.col("u").alias("node"), F.col("u").alias("comp")).distinct(), "labels")
    while True:
        near = (both.join(labels, both["u"] == labels["node"]).groupBy(F.col("v").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = staged(labels.join(near, "node", "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", F.coalesce("near", "comp")).alias("comp")), "step")
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        new = staged(step.join(jump, "comp").select("node", "old", F.col("top").alias("comp")), "labels")
        done = new.where(F.col("comp") != F.col("old")).isEmpty()
        unstage(labels, step)
        if done:
            unstage(both)
            return new.select("node", "comp")
        labels = new


def _joined_components(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) after new links: these are taken between components, each pair of
    components once, so many links between two large components are one edge."""
    edges = links.select("a", "b")
    if comp is not None:
        for end in ("a", "b"):
            c = comp.select(F.col("node").alias(end), F.col("comp").alias("c"))
            edges = edges.join(c, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    top = _min_labels(staged(edges.where(F.col("a") != F.col("b")).distinct(), "component-edges"))
    if comp is None:
        return top
    new = top.join(comp, "node", "left_anti")           # nodes that had no link before
    top = top.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    old = comp.join(top, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    return staged(old.unionByName(new), "components")


def _allowed(percent: int):
    """Size bound and positional bound of a pair of entries (n, place) and (m, spot)."""
    n, m = F.col("n"), F.col("m")
    overlap = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent) - F.lit(1e-9))
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (F.least(n - F.col("place"), m - F.col("spot")) >= overlap))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    j = pairs.join(a, "a").join(b, "b")
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return staged(j.where(both * 100 >= either * percent).select("a", "b"), "links")


def _nodes(sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, node sets, entries): the node of each document with a set, the sets that may link, their columns."""
    first = sets.where(F.col("n") > 0).groupBy("digest").agg(F.min("doc_id").alias("node"))
    first = staged(first, "nodes")
    own = sets.where(F.col("n") > 0).select("doc_id", "n", "digest")
    member = staged(own.join(first, "digest").select("doc_id", "n", "node"), "members")
    linked = sets.where(F.col("shingles").isNotNull())
    node_sets = staged(linked.join(first.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"])
                       .dropDuplicates(["digest", "doc_id"])
                       .select(F.col("doc_id").alias("node"), "n", "shingles", "columns", "places"), "node-sets")
    entries = node_sets.select("node", "n", F.posexplode(F.arrays_zip("columns", "places")).alias("k", "e"))
    entries = entries.select("node", "n", "k", F.col("e.columns").alias("col"), F.col("e.places").alias("place"))
    many = entries.groupBy("col").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1).select("col")
    return member, node_sets, staged(entries.join(staged(many, "columns"), "col"), "entries")


def _hooked(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) after one step of joining along new links: each component goes to the least that it links with,
    and on to where that one goes. What this leaves apart is joined later."""
    edges = links.select("a", "b")
    if comp is not None:
        for end in ("a", "b"):
            c = comp.select(F.col("node").alias(end), F.col("comp").alias("c"))
            edges = edges.join(c, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    hook = (edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .groupBy("a").agg(F.min("b").alias("to")).where(F.col("to") < F.col("a")))
    hook = staged(hook, "hooks")
    on = hook.select(F.col("a").alias("to"), F.col("to").alias("top"))
    hook2 = hook.join(on, "to", "left").select(F.col("a").alias("comp"), F.coalesce("top", "to").alias("top"))
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    if comp is not None:
        nodes = comp.select("node").unionByName(nodes).distinct().join(comp.select("node", "comp"), "node", "left")
    else:
        nodes = nodes.withColumn("comp", F.lit(None).cast("long"))
    nodes = nodes.withColumn("comp", F.coalesce("comp", "node"))
    out = staged(nodes.join(hook2, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")), "components")
    unstage(hook)
    return out


def _labelled(entries: DataFrame, comp: DataFrame | None) -> DataFrame:
    """The entries of columns that more than one component holds, with their component."""
    if comp is None:
        return entries.withColumn("comp", F.col("node"))
    all_ = entries.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = (all_.groupBy("col").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
             .where(F.col("x") != F.col("y")).select("col"))
    mixed = staged(mixed, "mixed")
    out = staged(all_.join(mixed, "col"), "open")
    unstage(mixed)
    return out


def _picked_pairs(open_: DataFrame, turn: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b): each open entry with up to 4 ** turn entries of its column, picked by hash, of other components;
    and the written table of picks.

    In the first turn the order of the picks is one for all columns, so near copies of
    one text meet the same pick, and a node is tried with the pick with which it shares most columns.
    Later each column has an order of its own, and a node is tried with the picks of all its columns.
    """
    order = F.xxhash64("node", F.lit(turn)) if not turn else F.xxhash64("node", "col", F.lit(turn))
    deal = F.pmod(F.xxhash64("node", F.lit(-turn)), F.lit(1 << min(2 * turn, 62)))
    pick = open_.groupBy("col", deal.alias("d")).agg(
        F.max_by(F.struct("node", "n", "place", "comp"), F.struct(order, "node")).alias("x"))
    pick = staged(pick.select("col", F.col("x.node").alias("b"), F.col("x.n").alias("m"),
                              F.col("x.place").alias("spot"), F.col("x.comp").alias("comp_b")), "picked")
    pairs = open_.join(pick, "col").where((F.col("comp") != F.col("comp_b")) & _allowed(percent))
    if turn:
        return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct(), pick
    pairs = pairs.groupBy("node", "b").agg(F.count(F.lit(1)).alias("overlap"))
    return pairs.groupBy(F.col("node").alias("a")).agg(F.max_by("b", F.struct("overlap", "b")).alias("b")), pick


def _pairs_left(open_: DataFrame, node_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): all that are left between different components, each made in the first column that it shares."""
    # a column's main component, the one with most entries in it, is met by the others but not by itself
    size = open_.groupBy("col", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = staged(size.groupBy("col").agg(F.max_by("comp", F.struct("c", "comp")).alias("main")), "main")
    # ``before`` holds an entry's earlier columns; written, so that the join stands on plain exchanges, which AQE can split
    before = F.slice("columns", 1, F.col("k")).alias("before")
    here = staged(open_.join(main, "col").join(node_sets.select("node", "columns"), "node").select(
        "col", F.col("node").alias("a"), "n", "place", "comp", "main", before), "here")
    rest = here.where(F.col("comp") != F.col("main"))
    other = here.select("col", F.col("a").alias("b"), F.col("n").alias("m"), F.col("place").alias("spot"),
                        F.col("comp").alias("comp_b"), F.col("before").alias("before_b"))
    pairs = rest.join(other, "col").where((F.col("comp") != F.col("comp_b")) & _allowed(percent)
                                          & ~F.arrays_overlap("before", "before_b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _node_components(member: DataFrame, node_sets: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the nodes that have a link or a tie."""
    # rows that repeat a doc_id with another text tie their nodes together, each to the least
    least = (member.groupBy(F.col("doc_id").alias("tied")).agg(F.min("node").alias("a"), F.max("node").alias("z"))
             .where(F.col("a") != F.col("z")).select("tied", "a"))
    ties = (member.join(staged(least, "tied"), F.col("doc_id") == F.col("tied")).where(F.col("node") != F.col("a"))
            .select("a", F.col("node").alias("b")).distinct())
    ties = staged(ties, "ties")
    comp = None if ties.isEmpty() else _joined_components(None, ties)
    found, left = [] if comp is None else [ties], entries
    for turn in count():
        open_ = _labelled(left, comp)
        pairs, pick = _picked_pairs(open_, turn, percent)
        links = _links(pairs, node_sets, percent)
        unstage(pick)
        if turn:
            unstage(left)                 # columns that are closed stay closed
        left = open_.drop("comp")
        left._staged_path = getattr(open_, "_staged_path", None)
        if links.isEmpty():
            break
        found.append(links)
        before, comp = comp, _hooked(comp, links)
        unstage(before)
    if comp is not None:
        everything = found[0].select("a", "b")
        for links in found[1:]:
            everything = everything.unionByName(links.select("a", "b"))
        comp = _joined_components(comp, everything)
    open_ = _labelled(left, comp)
    links = _links(staged(_pairs_left(open_, node_sets, percent), "pairs"), node_sets, percent)
    return _joined_components(comp, links)


def _rows(sets: DataFrame, member: DataFrame, comp: DataFrame, *more: str) -> DataFrame:
    """Per row doc_id, n, component_id and, of ``member``, the counts ``more``; an empty set is its own component."""
    out = member.join(comp, "node", "left").select("doc_id", "n", F.coalesce("comp", "node").alias("component_id"), *more)
    out = out.unionByName(sets.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id"),
                                                             *[F.lit(0).cast("long").alias(c) for c in more]))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(real("doc_id"), "n", real("component_id"), *more)


def components(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, component_id) from ``shingle_sets``."""
    nodes = _nodes(sets)
    return _rows(sets, nodes[0], _node_components(*nodes, percent))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                       percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n (size of its shingle set), component_id."""
    return components(shingle_sets(docs, id_col, text_col, n, percent), percent)


def node_links(node_sets: DataFrame, entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b), a < b: every pair of nodes that link, also within a component; made in its first shared column."""
    before = F.slice("columns", 1, F.col("k")).alias("before")
    here = staged(entries.join(node_sets.select("node", "columns"), "node")
                  .select("col", F.col("node").alias("a"), "n", "place", before), "entries-before")
    other = here.select("col", F.col("a").alias("b"), F.col("n").alias("m"), F.col("place").alias("spot"),
                        F.col("before").alias("before_b"))
    pairs = here.join(other, "col").where((F.col("a") < F.col("b")) & _allowed(percent)
                                          & ~F.arrays_overlap("before", "before_b"))
    return _links(staged(pairs.select("a", "b"), "pairs"), node_sets, percent)


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                  percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, members, links): the whole join, no link left out.

    documents has a row per row of ``docs``: doc_id, n, component_id, n_links,
    the number of other documents that its set links with. members has the
    node (equal sets) of each doc_id with a set, links the pairs (a, b), a < b,
    of nodes that link; documents of one node link as well. There are as many
    links as linking pairs of different sets, so their number grows with the
    square of a group of near copies. In members a null doc_id is NULL_ID.
    """
    sets = shingle_sets(docs, id_col, text_col, n, percent)
    member, node_sets, entries = _nodes(sets)
    links = node_links(node_sets, entries, percent)
    each = staged(member.select("doc_id", "node").distinct(), "members")
    near = (links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .unionByName(each.select(F.col("node").alias("a"), F.col("node").alias("b")).distinct()))
    near = staged(near, "near")
    size = each.groupBy(F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    reach = near.join(size, "b").groupBy("a").agg(F.sum("c").alias("reach"))
    # a document with several nodes counts once
    several = each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1).select("doc_id")
    again = (near.join(each.join(staged(several, "several"), "doc_id").withColumnRenamed("node", "b"), "b")
             .groupBy("a", "doc_id").agg((F.count(F.lit(1)) - 1).alias("c"))
             .groupBy("a").agg(F.sum("c").alias("again")))
    count = reach.join(again, "a", "left").select(
        F.col("a").alias("node"), (F.col("reach") - F.coalesce("again", F.lit(0)) - 1).alias("n_links"))
    count = staged(count, "link-counts")
    comp = _node_components(member, node_sets, entries, percent)
    return _rows(sets, member.join(count, "node"), comp, "n_links"), each, links


#: Stand-ins for the ids of rows that share theirs or lack one; larger than any id that has a row to itself.
_STAND_IN = 1 << 62


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                     percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id; columns unchanged.

    Rows that share a doc_id, or have none, are judged row by row: each text
    stands for itself under a stand-in, a hash of id and text, so a text of such a row
    is dropped only for a text that it links with. (Equal rows fare alike.)
    """
    rid, gone_id, many = unused(docs, "_near_id", "_near_gone", "_near_many")
    own = quoted(id_col).cast("long")
    shared = docs.where(own.isNotNull()).groupBy(own.alias(many)).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = staged(shared.select(many), "shared-ids")
    stand_in = F.xxhash64(own, quoted(text_col)).bitwiseAND(F.lit(_STAND_IN - 1)).bitwiseOR(F.lit(_STAND_IN))
    if shared.isEmpty():
        named = docs.withColumn(rid, F.coalesce(own, stand_in))
    else:
        named = docs.join(shared, own == F.col(many), "left")
        named = named.withColumn(rid, F.when(F.col(many).isNotNull() | own.isNull(), stand_in).otherwise(own)).drop(many)
    c = jaccard_components(named, rid, text_col, n, percent)
    gone = c.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(gone_id)).distinct()
    gone = staged(gone, "near-copies")
    return without(named, gone, F.col(rid), gone_id, F.col(rid) == F.col(gone_id)).drop(rid)
