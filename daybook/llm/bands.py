"""Bands of minimum hashes: texts that share one have many five-word shingles in common.

At a similarity (Jaccard) of 0.8, ``BANDS`` bands of ``ROWS_OF_BAND`` are missed once in 4,000
times; closer texts are missed far less often. A null text is an empty one; a text without
words has no bands.
"""

from __future__ import annotations

import numpy as np
import xxhash

from daybook.llm.simhash import shingle_hashes

SHINGLE = 5
BANDS = 16
ROWS_OF_BAND = 4
HASHES_AT_ONCE = 4096
#: Odd factors, each of which orders the hashes in another way.
FACTORS = np.array(
    [xxhash.xxh64_intdigest(str(i), 1) | 1 for i in range(BANDS * ROWS_OF_BAND)], np.uint64
)


def bands(text: str | None) -> list[int]:
    """The keys of the bands of a text."""
    parts = list(shingle_hashes(text, SHINGLE))
    if not parts:
        return []
    distinct = np.unique(np.concatenate(parts))
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(distinct), HASHES_AT_ONCE):
        ordered = distinct[start : start + HASHES_AT_ONCE] * FACTORS[:, None]
        least = np.minimum(least, ordered.min(axis=1))
    groups = least.reshape(BANDS, ROWS_OF_BAND)
    return [xxhash.xxh64_intdigest(group.tobytes(), i) - (1 << 63) for i, group in enumerate(groups)]
