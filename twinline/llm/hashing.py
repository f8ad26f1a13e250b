"""Vectorised hashes of byte ranges, words and shingles (numpy, uint64 with wrap-around)."""

from __future__ import annotations

import numpy as np

RADIX = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of RADIX modulo 2**64.
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (splitmix64's)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(seed: int, n: int = 256) -> np.ndarray:
    """n fixed pseudo-random words."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed * 1_000_003))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """RADIX**i and its inverses for i < n (kept for the largest n so far)."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, RADIX), np.full(size, INVERSE)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of data[start:end] for each range; equal bytes, equal hash, wherever they stand."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table(seed)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: ASCII letters in lower case, digits and bytes of other scripts stay; the rest is blank.
_FOLD = bytes(c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, index of its text). Words are runs of letters and digits in lower case."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw).translate(_FOLD), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begin = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])]) if raw else np.zeros(0, np.int64)
    return range_hashes(data, starts, ends, 1), np.searchsorted(begin, starts, side="right") - 1


def shingle_elements(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(element, index of its text), sorted by text then element.

    An element is a shingle of n words with its number of occurrence, so the
    set of elements is the bag of shingles. A text of fewer words has one
    shingle of all of them; one without words has none.
    """
    words, doc = word_hashes(texts)
    m = len(words)
    count = np.bincount(doc, minlength=len(texts)) if m else np.zeros(len(texts), np.int64)
    mult = table(7, n) | np.uint64(1)
    at = np.flatnonzero(doc[: m - n + 1] == doc[n - 1 :]) if m >= n else np.zeros(0, np.int64)
    sh = np.zeros(len(at), np.uint64)
    for j in range(n):
        sh += words[at + j] * mult[j]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = np.array([np.sum(words[f : f + count[d]] * mult[: count[d]]) for f, d in zip(first, short, strict=True)], np.uint64)
        sh, owner = np.concatenate([sh, extra]), np.concatenate([doc[at], short])
    else:
        owner = doc[at]
    sh = mix(sh)
    order = np.lexsort((sh, owner))
    sh, owner = sh[order], owner[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(sh)), 0))
    nth = (np.arange(len(sh)) - head).astype(np.uint64)
    return np.where(nth == 0, sh, mix(sh + nth * RADIX)), owner


def batches_of(sizes: list[int], limit: int = 2_000_000):
    """Consecutive index ranges whose sizes sum to about ``limit``."""
    start = total = 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield start, i
            start, total = i, 0
        total += s
    if start < len(sizes):
        yield start, len(sizes)
