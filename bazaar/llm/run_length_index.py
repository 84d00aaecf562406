"""A run-length index of byte strings: run-compressed Burrows-Wheeler transform
with samples at run ends, and matching statistics streamed from it.

Strings are joined with separators and their suffixes sorted by prefix doubling, to
as many symbols as the longest string has.  Of the
transform only its runs are kept, and for the first and last suffix of each run
the text position and the length it shares with the suffix before, or after, it.
Inside a run these lengths follow from the ones to the left: a suffix whose
neighbour is preceded by the same byte shares one byte less than the suffix that
starts one byte earlier.  Streaming the text from left to right therefore gives
all matching statistics from the samples alone.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols (uint16, below 2**15)."""
    n = len(text)
    wide = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
    key = (wide[:n] << np.uint64(48)) | (wide[1:n + 1] << np.uint64(32)) | (wide[2:n + 2] << np.uint64(16)) | wide[3:n + 3]
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    slot = np.arange(n)
    group = np.maximum.accumulate(np.where(head, slot, 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    h = 4
    while h < depth:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        pos = order[slots]
        after = pos + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[pos] * (n + 1) + second
        o = np.argsort(key, kind="stable")
        key, pos = key[o], pos[o]
        order[slots] = pos
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        head[slots] = new
        rank[pos] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        h *= 2
    return order


class RunLengthIndex:
    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        depth = 1 << max(2, int(lengths.max(initial=0)).bit_length())      # above any string
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        text = raw.astype(np.uint16) + 1
        text[self.starts + lengths] = 0                    # separators, below every byte
        n = len(text)
        self.n = n
        order = _suffix_order(text, depth)
        # the byte before each suffix; before a string's first byte stands a symbol of its own
        before = np.empty(n, np.int64)
        before[1:] = text[:-1]
        before[self.starts] = 1000 + np.arange(len(strings))
        bwt = before[order]
        cut = np.ones(n, bool)
        cut[1:] = bwt[1:] != bwt[:-1]
        first = np.flatnonzero(cut)
        last = np.append(first[1:], n) - 1
        self.run_symbols, self.run_lengths = bwt[first], last - first + 1
        room = np.repeat(self.starts + lengths, lengths + 1) - np.arange(n)     # up to the string's end
        sums = np.zeros(n + 1, np.uint64)
        power = np.full(n + 1, _BASE)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        np.cumsum(text.astype(np.uint64) * power[:n], out=sums[1:])
        inverse = np.full(n + 1, _INVERSE)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)

        def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Length that the suffixes at a and b share inside their strings."""
            most = np.minimum(np.minimum(room[a], room[b]), depth)
            low, step = np.zeros(len(a), np.int64), depth
            while step:
                to = low + step
                ok = to <= most
                x, y, t = a[ok], b[ok], to[ok]
                same = (sums[x + t] - sums[x]) * inverse[x] == (sums[y + t] - sums[y]) * inverse[y]
                low[np.flatnonzero(ok)[same]] += step
                step //= 2
            return low

        self.head_at, self.tail_at = order[first], order[last]
        self.head_shared = np.concatenate(([0], shared(order[first[1:]], order[first[1:] - 1])))
        self.tail_shared = np.concatenate((shared(order[last[:-1]], order[last[:-1] + 1]), [0]))

    def matching_statistics(self) -> np.ndarray:
        """Per text position the longest match that also starts elsewhere."""
        out = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for at, length in ((self.head_at, self.head_shared), (self.tail_at, self.tail_shared)):
            ends = np.full(self.n, -1, np.int64)
            sampled = np.full(self.n, -1, np.int64)
            sampled[at], ends[at] = at, at + length
            sampled = np.maximum.accumulate(sampled)
            np.maximum(out, np.where(sampled >= 0, ends[sampled] - place, 0), out=out)
        return out
