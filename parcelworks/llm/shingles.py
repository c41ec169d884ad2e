"""Word-shingle sets as arrays of 64-bit hashes, built in numpy inside tasks.

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR in the
UTF-8 text, after lower-casing A-Z.  All words of a block of texts are hashed at
once: prefix sums of position-weighted byte values give each word's polynomial
hash, whatever its place in the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

_BLOCK = 1 << 20  # bytes hashed at once; a longer text is cut between words
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACES = b" \t\n\x0b\x0c\r"
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_IS_SPACE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(_SPACES, np.uint8))


def words_of(text: str | None) -> list[bytes]:
    # surrogates cannot occur in Spark strings
    return text.encode("utf-8").lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 2 * _BLOCK), base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if len(held) <= 4 * _BLOCK:
            _POWERS[base] = held
    return held[:n]


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of lower-cased ``data``."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        if end < len(data):
            cut = _SPACE.search(data, end)
            end = cut.start() if cut else len(data)
        part = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[part]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * _powers(_BASE, len(part)), out=sums[1:])
        back = _powers(pow(_BASE, -1, 1 << 64), len(part))
        hashes.append(mix((sums[last] - sums[first]) * back[first]))
        starts.append(first + at)
        at = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def _shingled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(hashes)
    out = hashes[: n - width + 1].copy()
    for j in range(1, width):
        out = mix(out * _MULT + hashes[j : n - width + 1 + j])
    # the length distinguishes a short whole sequence from a full shingle
    return mix(out + np.uint64(width))


def _block_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    starts, hashes = _word_hashes(b"\n".join(texts).lower())
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    edges = np.searchsorted(starts, offsets)
    runs = _shingled(hashes, k) if len(hashes) >= k else None
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if lo == hi:
            yield np.empty(0, np.uint64)
            continue
        own = np.sort(runs[lo : hi - k + 1]) if hi - lo >= k else _shingled(hashes[lo:hi], hi - lo)
        fresh = np.ones(len(own), bool)
        np.not_equal(own[1:], own[:-1], out=fresh[1:])
        yield own[fresh]


def shingle_sets(texts: Iterable[str | None], k: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct hashes of its k-word shingles; a shorter text is one shingle of all its words."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8"))
        size += len(held[-1])
        if size >= _BLOCK:
            yield from _block_sets(held, k)
            held, size = [], 0
    yield from _block_sets(held, k)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    return next(shingle_sets([text], k))


def shingles_as_tuples(text: str | None, k: int) -> set:
    """The exact shingle set (word tuples), for verification."""
    words = words_of(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(k)), strict=False))
