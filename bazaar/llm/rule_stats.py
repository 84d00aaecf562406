"""Rule statistics of whole texts, computed for many documents at once."""

from __future__ import annotations

import numpy as np

from . import words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_bytes", "n_upper", "n_alpha", "n_digits", "n_lines", "n_symbol_words", "n_distinct_words", "n_bangs"]


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _by_doc(doc: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """BASE and EXTRA counts, one array entry per document."""
    n = len(offsets) - 1
    starts, ends, doc = words.word_bounds(data, offsets)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    symbol = _SYMBOL[data]
    symbols = np.concatenate(([0], np.cumsum(symbol, dtype=np.int64)))
    out = {
        "n_words": _by_doc(doc, n), "word_chars": _by_doc(doc, n, lead[ends] - lead[starts]),
        "n_symbols": _per_doc(symbol, offsets), "n_bytes": np.diff(offsets),
        "n_upper": _per_doc(_UPPER[data], offsets), "n_alpha": _per_doc(_ALPHA[data], offsets),
        "n_digits": _per_doc(_DIGIT[data], offsets), "n_bangs": _per_doc(data == 33, offsets),
        "n_symbol_words": _by_doc(doc[symbols[ends] > symbols[starts]], n),
    }

    # lines: cut at every \n and at document ends; those with a word count
    cut = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate((offsets[:-1][offsets[:-1] < offsets[1:]], cut[cut + 1 < len(data)] + 1)))
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    nxt = np.concatenate((line_start[1:], [len(data)]))
    line_end = np.minimum(nxt, offsets[line_doc + 1])
    line_end = line_end - ((line_end > line_start) & (data[line_end - 1] == 10)) if len(line_start) else line_end
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    h = words.hash_spans(data, line_start, line_end) ^ words.mix(line_doc.astype(np.uint64) + np.uint64(1))
    first = np.unique(h, return_index=True)[1]
    out["n_lines"] = _by_doc(line_doc, n)
    out["n_dup_lines"] = out["n_lines"] - _by_doc(line_doc[first], n)

    # words covered by three-word windows that the document holds twice or more
    own = words.hash_spans(data, starts, ends) ^ words.mix(doc.astype(np.uint64) + np.uint64(1))
    first = np.unique(own, return_index=True)[1]
    out["n_distinct_words"] = _by_doc(doc[first], n)
    repeated = np.zeros(len(own), bool)
    if len(own) >= 3:
        tri = own[:-2] * np.uint64(0xD6E8FEB86659FD93) + own[1:-1]
        tri = words.mix(tri * np.uint64(0xA0761D6478BD642F) + own[2:])
        at = np.flatnonzero(doc[:-2] == doc[2:])
        order = at[np.argsort(tri[at], kind="stable")]
        t = tri[order]
        same = t[1:] == t[:-1]
        twice = order[np.r_[False, same] | np.r_[same, False]] if len(t) else order
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = _by_doc(doc[repeated], n)
    return out
