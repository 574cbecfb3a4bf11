"""Replies of blocks by place."""

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import blocks as B
from tessera.llm import lm_scoring


def asked(merge, by_place, sent, n_blocks=3):
    """What each chunk gets back for the hashes that it sent, as (table of replies)."""
    entries = pa.concat_tables([B.to_blocks(i, n_blocks, h, [c]) for i, (h, c) in enumerate(sent)])
    run = B.merge_in_block([np.uint32], merge, by_place)
    got = pa.concat_tables([run(entries.filter(pa.array(entries["block"].to_numpy() == b))) for b in np.unique(entries["block"].to_numpy())])
    return [got.filter(pa.array(got["chunk"].to_numpy() == i)) for i in range(len(sent))]


def test_replies_by_place_say_the_same_in_far_fewer_bytes():
    r = np.random.default_rng(3)
    words = np.unique(r.integers(0, 1 << 64, 9000, np.uint64))
    sent = [(h, np.ones(len(h), np.uint32)) for h in (np.unique(r.choice(words, 5000)) for _ in range(2))]
    merge = lm_scoring._number(2)
    with_hashes, by_place = asked(merge, False, sent), asked(merge, True, sent)
    for (h, _), old, new in zip(sent, with_hashes, by_place):
        want, rank = B.joined(old, [np.uint32])
        at, got = B.placed(h, 3, new, [np.uint32])
        assert 0 < len(at) < len(h)
        assert (h[at] == want).all() and (got == rank).all()
        assert new["body"].nbytes * 3 < old["body"].nbytes


def test_replies_by_place_at_the_edges():
    h = np.array([5, 1 << 63], np.uint64)
    none, some = asked(lm_scoring._number(2), True, [(h, np.array([1, 1], np.uint32)), (h[:1], np.array([0], np.uint32))])
    assert none.num_rows == some.num_rows == 0
    at, rank = B.placed(h, 3, none, [np.uint32])
    assert len(at) == len(rank) == 0
    one, = asked(lm_scoring._number(2), True, [(h, np.array([1, 2], np.uint32))])
    assert [x.tolist() for x in B.placed(h, 3, one, [np.uint32])] == [[1], [0]]
    n, body = B.marked(np.array([True, False]), [])
    with pytest.raises(ValueError):
        B.unmarked(body, 2, n + 1, [])
