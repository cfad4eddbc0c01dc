"""Leaves are rank * size + place; those of very long words must stay below the mark of an empty one."""

from types import SimpleNamespace

import numpy as np

from tidewright.llm import bpe


def test_no_leaf_reaches_none():
    assert (1 << 20) * (1 << 41) < bpe.NONE < 1 << 63  # ranks below 2**20, words of terabytes


def test_a_leaf_beyond_two_to_the_forty_is_merged():
    high = 1 << 40  # times the size 2: as rank 32,768 in a word of size 2**25 and more
    m = SimpleNamespace(byte_ids=np.arange(256), rank=lambda a, b: np.full(len(a), high), by_pair={}, merged=SimpleNamespace(tolist=lambda: {high: 999}))
    assert bpe.merge_long(b"ab", m) == [999]
