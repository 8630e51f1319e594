"""A large group of near copies in the SimHash search."""

import tracemalloc

import numpy as np

from gridstats.llm import simhash


def test_a_dense_group_needs_little_memory_and_is_linked_whole():
    # All within six bits of each other, and each within three of the middle one.
    middle, bits = 0x0123456789ABCDEF, range(20)
    codes = np.array(sorted({middle ^ (1 << a | 1 << b | 1 << c)
                             for a in bits for b in bits for c in bits} | {middle}), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    tracemalloc.start()
    try:
        links = simhash._links(codes, np.zeros(len(codes), np.int64), 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(codes) == 1 + 20 + 190 + 1140 and len(links) == len(codes) - 1
    assert links["b"].nunique() == 1
    assert peak < 20e6
