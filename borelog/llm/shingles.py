"""Words and hashed word shingles of whole texts."""

import functools

import numpy as np
import xxhash

MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words, which end at ASCII white space only; ``lower`` lowers A-Z first."""
    data = text.encode()
    words = (data.lower() if lower else data).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


BASE, BLOCK = 0x5851F42D4C957F2D, 1 << 16


@functools.cache
def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.full(BLOCK, base, np.uint64)) * np.uint64(pow(base, -1, 2**64))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of the whole text if it has fewer words, and nothing if it has none.

    A run's hash is a polynomial in an odd base modulo 2**64, so sums of a prefix give all of them; long texts go in blocks.
    """
    width = min(width, len(hashes))
    if not width:
        return np.zeros(0, np.uint64)
    parts, count = [], len(hashes) - width + 1
    step = BLOCK - width + 1
    if step < 1:
        raise ValueError("a run is longer than a block")
    for start in range(0, count, step):
        part = hashes[start : start + BLOCK]
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(scramble(part) * _powers(BASE)[: len(part)])]
        parts.append((sums[width:] - sums[:-width]) * _powers(pow(BASE, -1, 2**64))[: len(part) - width + 1])
    return scramble(np.concatenate(parts) + MIX[:1] * np.uint64(width))


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit hashes."""
    return np.unique(windows(word_hashes(text), width))
