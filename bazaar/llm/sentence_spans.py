"""Substring de-duplication on sliding sentence spans.

A sentence ends after ``.``, ``!`` or ``?`` before white space, or at a line
break.  Every run of three consecutive sentences with ten words or more is
hashed (128 bits), and likewise runs of one or two sentences that already hold
25 words.  Where three sentences hold fewer words, the run grows: the shortest run
from each sentence, and the shortest up to each sentence, that reaches ten words is
hashed too (a sentence has a word at least, so it has at most ten sentences).  With
both, every sentence of a repeated passage of three sentences and ten words lies in
a hashed run inside the passage.  Runs are joined globally by hash: the first
occurrence, by (id, place), stays; sentences covered by any other are removed.

Occurrences after the first of a map task's chunk are known to repeat and aren't
compared any further, so a run that a third of the corpus shares reaches the
join once per chunk.

Defined cases: null text is empty text; sentences are compared without the white
space around them; rows with a null id come last in the order; rows with the same
id are ordered by row; an empty text has no sentences; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, deal, words

SENTENCES, WORDS = 3, 10       # a run of several sentences
LONG_RUN_WORDS = 25            # fewer sentences are a run with so many words
CHUNK_RUNS = 500_000           # runs gathered in a task before they are dealt out
LAST = np.iinfo(np.int64).max

RUNS = {"h1": "<u8", "h2": "<u8", "doc": "<i8", "row": "<i8", "first": "<i4", "n": "u1", "known": "u1"}


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per sentence: document, begin, end (white space after it included), bounds
    of its first and last word as indexes into ``word_bounds``."""
    starts, ends, doc = words.word_bounds(data, offsets)
    z = np.zeros(0, np.int64)
    if not len(starts):
        return z, z, z, z, z
    last = data[ends - 1]
    closes = (last == 46) | (last == 33) | (last == 63)
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    new = np.ones(len(starts), bool)
    new[1:] = closes[:-1] | (breaks[starts[1:]] > breaks[ends[:-1]]) | (doc[1:] != doc[:-1])
    w0 = np.flatnonzero(new)
    w1 = np.append(w0[1:], len(starts))
    d = doc[w0]
    begin = starts[w0].copy()
    head = np.r_[True, d[1:] != d[:-1]]
    begin[head] = offsets[d[head]]
    end = np.append(begin[1:], 0)
    tail = np.r_[d[1:] != d[:-1], True]
    end[tail] = offsets[d[tail] + 1]
    return d, begin, end, w0, w1


def runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Hashes of all runs: h1, h2, document, first sentence (in its document), sentences."""
    starts, ends, _ = words.word_bounds(data, offsets)
    d, _, _, w0, w1 = sentences(data, offsets)
    one, two = (words.hash_spans(data, starts[w0], ends[w1 - 1], *base) if len(d) else np.zeros(0, np.uint64)
                for base in ((), (words.OTHER_BASE,)))
    first_of = np.searchsorted(d, d)
    out: dict[str, list] = {k: [] for k in ("h1", "h2", "d", "first", "n")}
    h1 = h2 = np.zeros(len(d), np.uint64)
    size = w1 - w0
    for n in range(1, max(SENTENCES, WORDS) + 1):
        m = max(len(d) - n + 1, 0)
        h1 = words.mix(h1[:m] * np.uint64(0xD6E8FEB86659FD93) + one[n - 1:n - 1 + m])
        h2 = words.mix(h2[:m] * np.uint64(0xA0761D6478BD642F) + words.mix(two[n - 1:n - 1 + m] + np.uint64(n)))
        count = w1[n - 1:n - 1 + m] - w0[:m]
        if n <= SENTENCES:
            ok = (count >= LONG_RUN_WORDS) | ((n == SENTENCES) & (count >= WORDS))
        else:                      # one sentence less, at the end or at the beginning, is too short
            ok = (count >= WORDS) & (count - np.maximum(size[:m], size[n - 1:n - 1 + m]) < WORDS)
        ok &= d[:m] == d[n - 1:n - 1 + m]
        at = np.flatnonzero(ok)
        for k, v in (("h1", h1[at]), ("h2", h2[at]), ("d", d[at]), ("first", at - first_of[at]), ("n", np.full(len(at), n))):
            out[k].append(v)
    return {k: np.concatenate(v) for k, v in out.items()}


def _after_first(c: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Columns sorted by run and place, and which rows aren't the first of their run."""
    order = np.lexsort((c["first"], c["row"], c["doc"], c["h2"], c["h1"]))
    c = {k: v[order] for k, v in c.items()}
    return c, ~deal.heads(c["h1"], c["h2"])


def _deal_runs(parts: int):
    def flush(held: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        c, again = _after_first({k: np.concatenate([h[k] for h in held]) for k in RUNS})
        c["known"] = again.astype(np.uint8)
        # what is known to go needs no comparison: it is dealt by row, so that a run that
        # half of the corpus holds doesn't meet in one task
        return deal.blobs(RUNS, c, np.where(again, words.mix(c["row"].astype(np.uint64)), c["h1"]), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            row = np.asarray(batch.column(0))
            doc = np.array([LAST if i is None else i for i in batch.column(1).to_pylist()], np.int64)
            for first, _, data, offsets in common.text_steps(batch.column(2)):
                r = runs(data, offsets)
                at = first + r["d"]
                held.append({"h1": r["h1"], "h2": r["h2"], "doc": doc[at], "row": row[at], "first": r["first"],
                             "n": r["n"], "known": np.zeros(len(at), np.uint8)})
                n += len(at)
                if n >= CHUNK_RUNS:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)
    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: first sentences and lengths of the runs to remove."""
    for c in deal.gathered(RUNS, batches):
        known = c["known"] == 1
        fresh, again = _after_first({k: v[~known] for k, v in c.items()})
        row = np.concatenate([c["row"][known], fresh["row"][again]])
        if not len(row):
            continue
        first = np.concatenate([c["first"][known], fresh["first"][again]]).astype(np.int64)
        n = np.concatenate([c["n"][known], fresh["n"][again]]).astype(np.int64)
        order = np.argsort(row, kind="stable")
        row, first, n = row[order], first[order], n[order]
        at = np.append(np.flatnonzero(deal.heads(row)), len(row)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[at[:-1]]), pa.ListArray.from_arrays(pa.array(at), pa.array(first)),
             pa.ListArray.from_arrays(pa.array(at), pa.array(n))], names=["row", "first", "n"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))
    for batch in batches:
        firsts, ns = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for lo, hi, data, offsets in common.text_steps(batch.column(1)):
            d, begin, end, _, _ = sentences(data, offsets)
            cut = np.searchsorted(d, np.arange(hi - lo + 1))
            raw, out = data.tobytes(), []
            for i in range(lo, hi):
                a, b = cut[i - lo], cut[i - lo + 1]
                gone = np.zeros(b - a + 1, np.int64)
                for f, n in zip([x for y in firsts[i] or [] for x in y], [x for y in ns[i] or [] for x in y]):
                    gone[f] += 1
                    gone[f + n] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.r_[0, gone.view(np.int8), 0]))
                if gone.any():
                    text = b"".join(raw[begin[a + k]:end[a + k]] for k in np.flatnonzero(~gone))
                else:
                    text = raw[offsets[i - lo]:offsets[i - lo + 1]]
                out.append((b - a, int(gone.sum()), [{"first": int(x), "n": int(y - x)} for x, y in edge.reshape(-1, 2)],
                            text.decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], span),
                 pa.array([o[3] for o in out], pa.string())],
                names=["id", "n_sentences", "n_removed", "removed_spans", "kept_text"])


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_sentences, n_removed, removed_spans, kept_text).
    ``removed_spans`` are maximal ranges of sentences (first, n), counted from 0."""
    base = common.with_row(common.numbered(docs, [id_col, text_col])).select(F.col(common.ROW).alias("row"), F.col(id_col).cast("long").alias("id"),
                                        F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = deal.shuffle(base.mapInArrow(_deal_runs(parts), deal.schema(RUNS)))
    found = dealt.mapInArrow(_repeated, "row long, first array<long>, n array<long>")
    found = found.groupBy("row").agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n"))
    out = (base.join(found, "row", "left").select("id", "text", "first", "n")
           .mapInArrow(_remove, "id long, n_sentences long, n_removed long, "
                                "removed_spans array<struct<first:bigint,n:bigint>>, kept_text string"))
    return out.withColumnRenamed("id", id_col)
