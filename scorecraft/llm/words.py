"""Word hashing: words and word shingles of a text as 64-bit hashes.

A word is a run of anything but space and \\x09-\\x0D, as ``bytes.split`` cuts
UTF-8; ``mix`` turns hashes into further well-spread 64-bit values.
"""

from __future__ import annotations

import numpy as np
import xxhash


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finaliser of splitmix64 (published constants)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    words = data.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; a text of fewer words is one shingle of all."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    out = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j:len(hashes) - k + 1 + j]
    return mix(out, k)
