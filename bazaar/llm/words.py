"""Vectorised words and word shingles of UTF-8 text.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` of the ASCII-lower-cased text;
a shingle is five consecutive words.  Words and shingles are represented by
64-bit hashes, computed for many documents at once.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
#: Another odd number, for a second hash of the same bytes.
OTHER_BASE = 0xC2B2AE3D27D4EB4F
_SEGMENT = 1 << 21
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
        steps[0] = 1
        table = np.multiply.accumulate(steps)
        if size <= 2 * _SEGMENT:
            _powers[base] = table
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of data[start:end] for every span, by prefix sums of a polynomial in ``base``."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _power_table(base, n + 1)[:n]
    np.cumsum(terms, out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= _power_table(pow(base, -1, 1 << 64), n + 1)[starts]
    h += (ends - starts).astype(np.uint64)
    return mix(h)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document index) of every word; words end at document ends."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = word[heads]
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    stop[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = word[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """``span_hashes`` of ordered spans.  Beyond a few MB the data are taken in
    segments of whole spans, so scratch memory stays bounded."""
    if len(data) <= _SEGMENT:
        return span_hashes(data, starts, ends, base)
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + _SEGMENT, "right")), i + 1)
        a = starts[i]
        out.append(span_hashes(data[a:ends[j - 1]], starts[i:j] - a, ends[i:j] - a, base))
        i = j
    return np.concatenate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every word of the lower-cased text, in order."""
    data = _LOWER[data]
    starts, ends, doc = word_bounds(data, offsets)
    return hash_spans(data, starts, ends), doc


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per document the sorted distinct shingle hashes.  With one to four words
    the whole sequence is the one shingle; without words the set is empty."""
    h, doc = word_hashes(data, offsets)
    n_docs = len(offsets) - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    rolled = np.zeros(0, np.uint64)
    if len(h) >= SHINGLE:
        rolled = np.zeros(len(h) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - SHINGLE + 1 + k]
        rolled = mix(rolled)
    out = []
    for d in range(n_docs):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= SHINGLE:
            s = np.sort(rolled[a:b - SHINGLE + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            v = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    v = v * np.uint64(0xA0761D6478BD642F) + x
            out.append(mix(np.array([v], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
