"""Periodic runs of words, found on a harmonic grid and extended by grammar queries.

A run of period p and at least 4 p words holds four neighbouring multiples of p, at
which its words are equal.  For every p all multiples of p of a batch are compared at
once (n / p of them: a harmonic sum); of each stretch of equal grid words every third
pair of neighbours is a candidate, which still leaves one inside every run.  Texts
with a candidate get one run-length grammar by recompression (``run_grammar``), whose
queries extend the candidate pairs to both sides exactly.  Stretches of several
multiples of a period have the same ends, so of equal ends the least period stays.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``; a batch numbers them by a
dictionary of whole words, and walls between texts keep runs inside them.

Defined cases: null or empty text, or a text without words, has no run and collapses
to the empty string; ids (null or repeated) are passed through; further columns are
ignored; an empty table gives no rows; a long text is a batch of its own, in memory
as arrays of some hundred bytes a word in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .run_grammar import RunGrammar

STEP_BYTES = 2 << 20
TIMES = 4            # a run has at least this many periods
LEAST = 6            # and at least so many words

Run = tuple[int, int, int]      # start, period, length


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of all texts, by a hash of their id, end in repetitions of one stretch
    of theirs.  A text without an id stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _walled(names: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts with a unique wall before each and at the end, True at walls, start of
    each text)."""
    parts: list[np.ndarray] = []
    for k, x in enumerate(names):
        parts += [np.array([n_words + k]), x]
    base = np.concatenate([*parts, np.array([n_words + len(names)])])
    starts = np.cumsum([0, *[len(x) + 1 for x in names]]) + 1
    return base, base >= n_words, starts


def _grid(base: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every candidate: the words there and a period later are
    equal and belong to four equal neighbours on the grid."""
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in range(1, longest // TIMES + 1):
        grid = base[::p]
        same = grid[1:] == grid[:-1]
        if np.count_nonzero(same) < TIMES - 1:
            continue
        triple = same[:-2] & same[1:-1] & same[2:]
        if not triple.any():
            continue
        inside = np.zeros(len(same), bool)
        for k in range(TIMES - 1):
            inside[k:len(inside) - 2 + k] |= triple
        at = np.flatnonzero(inside[::TIMES - 1]) * (TIMES - 1)
        places.append(at * p)
        periods.append(np.full(len(at), p))
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """Per text (a list of words) its runs, ordered by start, then period."""
    number: dict[bytes, int] = {}
    names = [np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in texts]
    out: list[list[Run]] = [[] for _ in texts]
    long = [d for d, x in enumerate(names) if len(x) >= LEAST]
    if not long:
        return out
    base, _, starts = _walled([names[d] for d in long], len(number))
    place, _ = _grid(base, max(len(names[d]) for d in long))
    if not len(place):
        return out
    some = [long[k] for k in np.unique(np.searchsorted(starts, place, "right") - 1)]
    base, wall, starts = _walled([names[d] for d in some], len(number))
    place, period = _grid(base, max(len(names[d]) for d in some))
    grammar = RunGrammar(base, wall)
    start = place - grammar.extend(place - 1, place + period - 1, back=True)
    end = place + period + grammar.extend(place, place + period)
    good = end - start >= np.maximum(LEAST, TIMES * period)
    found = np.unique(np.stack([start[good], end[good], period[good]], 1), axis=0)
    last = None
    for s, e, p in found.tolist():
        if (s, e) != last:
            d = int(np.searchsorted(starts, s, "right")) - 1
            out[some[d]].append((s - int(starts[d]), p, e - s))
        last = s, e
    for runs in out:
        runs.sort()
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, p, n in runs:
        keep[s + p:s + n] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; then least start, period."""
    best: Run | None = None
    for run in runs:
        if best is None or run[2] * best[1] > best[2] * run[1]:
            best = run
    return best


def _texts(batches: Iterator[pa.RecordBatch], rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    for batch in batches:
        for first, end, data, offsets in common.text_steps(batch.column(1), STEP_BYTES):
            ids = batch.column(0).slice(first, end - first)
            raw = data.tobytes()
            words = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            if rewrite:
                words = [rewrite(i, w) for i, w in zip(ids.to_pylist(), words)]
            yield ids, words, runs_of(words)


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """(id, runs array<(start, length, period)>, collapsed string).  ``rewrite(id,
    words)`` may change a text's words first."""
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for ids, words, runs in _texts(batches, rewrite):
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([[{"start": s, "length": n, "period": p} for s, p, n in r] for r in runs], kinds),
                pa.array([b" ".join(collapsed(w, r)).decode() for w, r in zip(words, runs)], pa.string())],
                names=[id_col, "runs", "collapsed"])

    return _base(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """One row per text: n_runs, start, length, period and exponent of the strongest
    run, digests of all runs and of the collapsed text."""
    names = [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches):
        for ids, words, runs in _texts(batches, rewrite):
            best = [strongest(r) for r in runs]
            listed = ["".join(f"{s},{n},{p}\n" for s, p, n in r).encode() for r in runs]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(r) for r in runs], pa.int64()),
                *[pa.array([None if b is None else b[k] for b in best], pa.int64()) for k in (0, 2, 1)],
                pa.array([None if b is None else 1000 * b[2] // b[1] for b in best], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in listed], pa.string()),
                pa.array([hashlib.sha256(b" ".join(collapsed(w, r))).hexdigest() for w, r in zip(words, runs)], pa.string())],
                names=names)

    return _base(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string")
