"""Operator 13, conversation prefix trie by vertical bitmaps.

A node of depth d is a distinct sequence of first d turns (role, text); its
members are the conversations that begin with it; the root has depth 0.

1. *Numbers.* Conversations in order of conv_id get ordinals; each turn gets
   its place and the running exclusive-or of 128 bits hashed from (place, turn
   key), which names the prefix that it ends (``scans.group_scan``, so that a
   conversation of any length is spread over tasks). The turn key is the MD5 of
   role and text; no text is shuffled.
2. *Shards.* A shard holds ``CONVERSATIONS`` consecutive ordinals and
   ``DEPTHS`` consecutive depths, so its size is bounded whatever the input.
   It indexes (depth, turn) to a bitset of its conversations, and walks the
   trie depth first: the children of a node are the intersections of its
   bitset with the postings of the next depth. A child is found from the lowest bit not yet
   covered, so there are as many intersections as nodes. Each node gives
   its popcount, its smallest member and the list of members that end there.
3. *Merge.* Nodes of several shards are added up by their prefix name; a
   prefix that a third of all conversations share is one row per shard. End
   lists of a node come in shard order, so its digest is taken as a stream.
4. *Subtrees.* The nodes whose smallest member is c are one unbroken chain of
   depths, down to c's end. So sums over a subtree are: the sums over the rest
   of the chain (a running sum up the chain), and, for every other member,
   the total of its own chain. The latter is one aggregate over (conversation,
   depth above its chain), with partial sums.

Prefixes are equal if their 128-bit names are. Rows of equal turn (null
first) stand in order of their turn keys. Null role or text is empty; rows
without a conv_id belong to no conversation and are left out; repeated rows
are turns like any other; an empty table has no node, not even a root.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .scans import group_scan

CONVERSATIONS = 2048
DEPTHS = 64
_LISTS = "array<long>"
_NODES = ("shard long, depth long, s1 long, s2 long, p1 long, p2 long, n_convs long, conv_id long, n_bytes long, "
          f"ends {_LISTS}")
_NAMES = [f.strip().split(" ")[0] for f in _NODES.split(",")]
_KEY = ["depth", "s1", "s2"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, n_bytes): what the trie needs of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place, key, n_bytes): the turns with their 0-based place."""
    t = group_scan(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("key")], name="turns")
    return t.select("conv_id", (F.col("n") - 1).alias("place"), "key", "n_bytes")


def _bits(mask: int) -> list[int]:
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def _walk(table: pa.Table) -> pa.Table:
    """The nodes of one shard, depth first."""
    cols = {c: table[c].to_pylist() for c in table.column_names}
    shard = cols["shard"][0] if table.num_rows else 0
    postings: dict[tuple, int] = defaultdict(int)      # (depth, turn) -> conversations
    turn_of: dict[tuple, tuple] = {}                   # (depth, bit) -> turn
    here: dict[int, int] = defaultdict(int)            # depth -> conversations with a turn there
    over: dict[int, int] = defaultdict(int)            # depth -> conversations that end there
    entry: dict[tuple, int] = defaultdict(int)         # prefix above the shard -> conversations
    conv: dict[int, int] = {}
    n_bytes: dict[tuple, int] = {}
    top = min(cols["depth"], default=0) // DEPTHS * DEPTHS
    for bit, depth, s1, s2, t1, t2, size, last, c in zip(*(cols[k] for k in (
            "bit", "depth", "s1", "s2", "t1", "t2", "n_bytes", "last", "conv_id"))):
        one = 1 << bit
        conv[bit] = c
        turn_of[depth, bit] = turn = (t1, t2)
        postings[depth, turn] |= one
        n_bytes[depth, turn] = size
        here[depth] |= one
        if last:
            over[depth] |= one
        if depth == top:
            entry[s1 ^ t1, s2 ^ t2] |= one
    out: list[tuple] = []
    stack = [(mask, top, p1, p2) for (p1, p2), mask in entry.items()]
    while stack:
        parent, depth, p1, p2 = stack.pop()
        rest = parent & here.get(depth, 0)
        while rest:
            low = (rest & -rest).bit_length() - 1
            turn = turn_of[depth, low]
            child = parent & postings[depth, turn]
            rest &= ~child
            s1, s2 = p1 ^ turn[0], p2 ^ turn[1]
            out.append((shard, depth, s1, s2, p1, p2, child.bit_count(), conv[low], n_bytes[depth, turn],
                        [conv[b] for b in _bits(child & over.get(depth, 0))]))
            stack.append((child, depth + 1, s1, s2))
    types = [pa.int64()] * 9 + [pa.list_(pa.int64())]
    columns = list(zip(*out)) if out else [()] * 10
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def _digests(batches):
    """SHA-256 of each node's end lists, which come one after another in shard order."""
    import hashlib
    node, state, some = None, None, False
    done: list[tuple] = []

    def close():
        if node is not None:
            done.append((*node, state.hexdigest()))

    def flush():
        cols = list(zip(*done)) if done else [()] * 4
        batch = pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]],
                                            pa.array(cols[3], pa.string())], [*_KEY, "ends_sha256"])
        done.clear()
        return batch
    for b in batches:
        for r in range(b.num_rows):
            key = tuple(b.column(i)[r].as_py() for i in range(3))
            if key != node:
                close()
                node, state, some = key, hashlib.sha256(), False
            ids = b.column(4)[r].as_py()
            state.update(((b"," if some else b"") + ",".join(map(str, ids)).encode()))
            some = True
        yield flush()
    close()
    yield flush()


def _paths(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation and depth, 0 included, with the name of the prefix that ends there."""
    place = F.col("place").cast("long")
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), (place + 1).alias("depth"),
                     F.xxhash64(F.lit(1), place, "key").alias("t1"), F.xxhash64(F.lit(2), place, "key").alias("t2"),
                     F.col("n_bytes").cast("long").alias("n_bytes"))
    zero = F.lit(0).cast("long")
    roots = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), zero.alias("depth"),
                                 zero.alias("t1"), zero.alias("t2"), zero.alias("n_bytes"))
    p = group_scan(t.unionByName(roots), "conv_id", [F.col("depth")], xors=["t1", "t2"], name="paths")
    return p.withColumnsRenamed({"cum_t1": "s1", "cum_t2": "s2"})


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: (conv_id, place, key, n_bytes), places from 0 without gaps
    (``numbered``); ``conversations``: (conv_id), each once, those without
    turns included.
    """
    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = staged(_paths(turns, conversations).select(
        "conv_id", "depth", "s1", "s2", "t1", "t2", "n_bytes", "last",
        F.expr(f"ordinal div {CONVERSATIONS}").alias("shard"), F.expr(f"ordinal % {CONVERSATIONS}").alias("bit"),
        F.expr(f"depth div {DEPTHS}").alias("band")), "trie-paths")
    parts = staged(paths.groupBy("shard", "band").applyInArrow(_walk, _NODES), "trie-parts")
    ends = parts.where(F.size("ends") > 0).select(*_KEY, "shard", "ends")
    ends = ends.repartition(width, *_KEY).sortWithinPartitions(*_KEY, "shard").mapInArrow(
        _digests, "depth long, s1 long, s2 long, ends_sha256 string")
    nodes = parts.groupBy(*_KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.size("ends")).alias("n_ends"))
    # a node is childless if all its members end there
    nodes = staged(nodes.select(
        "conv_id", *_KEY, "p1", "p2", "n_convs", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf")), "trie-nodes")
    # the chain from each node down: running sums from its deepest node up; its last row is its top node
    down = group_scan(nodes, "conv_id", [F.col("depth").desc()], sums=["saved", "leaf"], name="trie-chains")
    # what a conversation's own chain adds to the nodes above it
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"),
                                          F.sum("leaf").alias("leaf"))
    above = paths.select("conv_id", *_KEY).join(chains, "conv_id").where("depth < top")
    # within a chain the parent has the same smallest member; a top node's parent is looked up
    tops = down.where("last and depth > 0").select(
        *_KEY, (F.col("depth") - 1).alias("up"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    parents = nodes.select(F.col("depth").alias("up"), F.col("s1").alias("q1"), F.col("s2").alias("q2"),
                           F.col("conv_id").alias("parent"))
    tops = tops.join(parents, ["up", "q1", "q2"])
    children = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"),
                                               F.col("p2").alias("s2"), F.lit(1).cast("long").alias("children"))
    own = down.select(*_KEY, "conv_id", "n_convs", F.when(~F.col("last"), F.col("conv_id")).alias("parent"),
                      F.col("cum_saved").alias("saved"), F.col("cum_leaf").alias("leaf"))
    # everything that is said of a node meets in one aggregate
    said = own
    for more in (above.select(*_KEY, "saved", "leaf"), tops.select(*_KEY, "parent"), children, ends):
        said = said.unionByName(more, allowMissingColumns=True)
    both = said.groupBy(*_KEY).agg(
        F.max("conv_id").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.coalesce(F.sum("children"), F.lit(0)).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    return both.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       "ends_sha256")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table (conv_id, turn, role, text), its conversations as they stand."""
    turns = numbered(turn_rows(conversations))
    return prefix_trie(turns, turns.select("conv_id").distinct())
