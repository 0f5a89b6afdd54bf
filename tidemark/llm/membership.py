"""A Bloom filter with a fixed bound on its size, filled on the executors and broadcast."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.shared import merged_array, mix

#: Bits at least and at most; more members only make it let more through, and an exact join follows.
BITS = (16, 27)


def _places(node: np.ndarray, bits: int):
    h = mix(node)
    return h >> np.uint64(64 - bits), (h & np.uint64(0xFFFFFFFF)) * np.uint64(0x9E3779B1) % np.uint64(1 << bits)


def member_bits(nodes: DataFrame, count: int) -> np.ndarray:
    """The filter of the column node (long) of nodes, which has count rows."""
    bits = min(max((16 * count).bit_length(), BITS[0]), BITS[1])

    def fill(frames):
        out = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for pdf in frames:
            for h in _places(pdf["node"].to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(out, (h >> np.uint64(3)).astype(np.int64), np.uint8(1) << (h & np.uint64(7)).astype(np.uint8))
        return out

    return merged_array(nodes.select("node"), fill, 1 << (bits - 3), np.uint8, np.bitwise_or)


def maybe_in(nodes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each of nodes (uint64) may be a member."""
    bits, out = (len(table) * 8).bit_length() - 1, np.ones(len(nodes), dtype=bool)
    for h in _places(nodes, bits):
        out &= (table[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out
