"""Hashed word shingles of whole texts."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
# Bytes hashed at a time; a slice ends at white space, so a longer word makes a longer slice.
SLICE = 1 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, inverse))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (what ASCII white space parts) of a text's bytes."""
    raw = np.frombuffer(text, np.uint8)
    found, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + SLICE)
        while end < len(raw) and not _BLANK[raw[end]]:
            end += 1
        found.append(_hashed(raw[at:end]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _hashed(raw: np.ndarray) -> np.ndarray:
    inside = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    size = 1 << max(12, len(raw).bit_length())
    up, down = _powers(max(size, SLICE) if size <= 2 * SLICE else size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((raw + np.uint64(1)) * up[: len(raw)])])
        return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``words`` words, in order. A text of fewer words, but at least
    one, is a single shingle; null and a text without words have none."""
    hashed = word_hashes(text.lower().encode("utf-8", "surrogatepass")) if text else np.zeros(0, np.uint64)
    if not len(hashed):
        return hashed
    words = min(words, len(hashed))
    runs = len(hashed) - words + 1
    made = mixed(hashed[:runs], words)
    with np.errstate(over="ignore"):
        for n in range(1, words):
            made = mixed(made * np.uint64(3) + hashed[n : n + runs], n)
    return made
