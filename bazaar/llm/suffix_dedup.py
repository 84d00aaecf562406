"""Suffix-array de-duplication: remove bytes that repeat for ``LENGTH`` and more.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else in the corpus.  Strings never cross documents and are judged on the
input.

1. Equal whole texts form one class; a class of several long enough texts goes
   whole, and one text stands for the class below.
2. Every window of ``LENGTH`` bytes has an anchor: the smallest hash of its
   ``PROBE``-byte strings.  Anchors are dealt by hash and counted; equal windows
   have equal anchors, so windows with an anchor that is seen once are unique.
3. The other windows are grouped by a second, wider-spaced anchor (strings of
   ``KEY`` bytes).  Neighbouring windows with one anchor make a segment of text,
   dealt by anchor, so equal windows meet in one bucket.
4. Each bucket gets a run-length index of its distinct segments, and matching
   statistics streamed from it mark windows that occur again.  Segments that
   occur several times as a whole are indexed once.
5. Windows of an anchor with more than ``HOT_SEGMENTS`` occurrences (a passage
   that a good part of the corpus shares, with many texts around it) don't fit
   one bucket; they are dealt by a 128-bit hash of their own, which splits any
   anchor.

Defined cases: null text is empty text; documents shorter than ``LENGTH`` have no
windows, and lose nothing; ids may be null or repeated (rows are told apart by
row number); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, deal, words
from .run_length_index import RunLengthIndex

LENGTH = 400
PROBE = 256
KEY = 32
CHUNK = 1 << 22                # bytes of one text whose anchors are sought at a time
CHUNK_ANCHORS = 1_000_000
BUCKET_BYTES = 2 << 20         # segments of one run-length index, on average
HOT_SEGMENTS = 20_000

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# -- anchors ---------------------------------------------------------------------

def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-byte string."""
    n = len(data) - k + 1
    at = np.arange(n)
    return words.span_hashes(data, at, at + k)


def _window_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: prefix and suffix minima of blocks."""
    n = len(x)
    if w == 1:
        return x
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def anchors(data: np.ndarray, k: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``length`` bytes the place of its anchor (leftmost of the
    smallest), and the hashes of all k-byte strings."""
    h = _gram_hashes(data, k)
    low = np.uint64((1 << 24) - 1)
    packed = (words.mix(h) & ~low) | np.arange(len(h), dtype=np.uint64)
    return (_window_minimum(packed, length - k + 1) & low).astype(np.int64), h


def _chunks(n: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte ranges that hold every window of a text of n bytes exactly once."""
    at = 0
    while at + length <= n:
        end = min(n, at + CHUNK + length - 1)
        yield at, end
        at = end - length + 1


# -- step 1 and 2 ------------------------------------------------------------------

INFO = "row long, id long, n_bytes long, c1 long, c2 long, sha string"
ANCHORS = {"h": "<u8", "c1": "<i8", "c2": "<i8", "pos": "<i8"}


def _class_of(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.fill_null(batch.column(2).cast(pa.large_string()), "").cast(pa.large_binary())
        digests = [hashlib.sha256(t.as_buffer()).digest() for t in text]
        cls = [_class_of(d) for d in digests]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pc.binary_length(text).cast(pa.int64()),
             pa.array([c[0] for c in cls], pa.int64()), pa.array([c[1] for c in cls], pa.int64()),
             pa.array([d.hex() for d in digests])], names=["row", "id", "n_bytes", "c1", "c2", "sha"])


def _deal_anchors(parts: int, length: int, probe: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, seen = 0, set()
        for batch in batches:
            for _, _, data, offsets in common.text_steps(batch.column(0)):
                for a, b in zip(offsets[:-1], offsets[1:]):
                    if b - a < length:
                        continue
                    own = data[a:b]
                    cls = _class_of(hashlib.sha256(own).digest())
                    if cls in seen:
                        continue
                    seen.add(cls)
                    for lo, hi in _chunks(len(own), length):
                        at, h = anchors(own[lo:hi], probe, length)
                        at = at[np.r_[True, at[1:] != at[:-1]]]
                        held.append((h[at], cls, at + lo))
                        count += len(at)
                if count >= CHUNK_ANCHORS:
                    yield flush(held)
                    held, count, seen = [], 0, set()
        if held:
            yield flush(held)

    def flush(held):
        sizes = [len(x[0]) for x in held]
        h = np.concatenate([x[0] for x in held])
        return deal.blobs(ANCHORS, {"h": h, "c1": np.repeat([x[1][0] for x in held], sizes),
                                    "c2": np.repeat([x[1][1] for x in held], sizes),
                                    "pos": np.concatenate([x[2] for x in held])}, h, parts)
    return run


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class the places of anchors that occur again."""
    for c in deal.gathered(ANCHORS, batches):
        order = np.lexsort((c["pos"], c["c2"], c["c1"], c["h"]))
        h, c1, c2, pos = (c[k][order] for k in ANCHORS)
        one = deal.heads(h, c1, c2, pos)
        h, c1, c2, pos = h[one], c1[one], c2[one], pos[one]
        new = deal.heads(h)
        again = ~new
        again[:-1] |= ~new[1:]
        c1, c2, pos = c1[again], c2[again], pos[again]
        if not len(pos):
            continue
        order = np.lexsort((c2, c1))
        c1, c2, pos = c1[order], c2[order], pos[order]
        at = np.append(np.flatnonzero(deal.heads(c1, c2)), len(pos)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(c1[at[:-1]]), pa.array(c2[at[:-1]]),
                                          pa.ListArray.from_arrays(pa.array(at), pa.array(pos))], names=["c1", "c2", "pos"])


# -- step 3 --------------------------------------------------------------------------

SEGMENTS = "anchor long, row long, start long, n long, content binary"


def _segments(length: int, probe: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            rows, places = batch.column(0).to_pylist(), batch.column(2)
            text = pc.fill_null(batch.column(1).cast(pa.large_string()), "").cast(pa.large_binary())
            for i in range(batch.num_rows):
                data = np.frombuffer(text[i].as_buffer(), np.uint8)
                # array<array<long>>: one list per task that counted anchors of this text
                wanted = np.sort(np.asarray(places[i].values.flatten(), np.int64))
                for lo, hi in _chunks(len(data), length):
                    chunk = data[lo:hi]
                    at, _ = anchors(chunk, probe, length)
                    at = at + lo
                    k = np.searchsorted(wanted, at)
                    repeated = wanted[np.minimum(k, len(wanted) - 1)] == at
                    if not repeated.any():
                        continue
                    at, h = anchors(chunk, key, length)
                    cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (repeated[1:] != repeated[:-1])])
                    for a, b in zip(cut, np.append(cut[1:], len(at))):
                        if repeated[a]:
                            content = chunk[a:b + length - 1].tobytes()
                            out.append((int(h[at[a]].view(np.int64)), rows[i], int(lo + a), int(b - a), content))
                            size += len(content)
                if size >= 4 << 20:
                    yield _segment_rows(out)
                    out, size = [], 0
            if out:
                yield _segment_rows(out)
    return run


def _segment_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)],
                                      names=["anchor", "row", "start", "n", "content"])


# -- step 4 --------------------------------------------------------------------------

SPANS = "row long, start long, n long"


def _span_rows(spans: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s[k] for s in spans], pa.int64()) for k in range(3)],
                                      names=["row", "start", "n"])


def _mark(segments: dict[bytes, list[tuple[int, int, int]]], length: int) -> list[tuple[int, int, int]]:
    """Byte spans (row, start, length) covered by windows that occur again."""
    if not segments:
        return []
    contents = list(segments)
    index = RunLengthIndex(contents)
    statistics = index.matching_statistics()
    out = []
    for content, begin in zip(contents, index.starts):
        places = segments[content]
        windows = len(content) - length + 1
        if len(places) > 1:
            marked = [(0, windows)]
        else:
            long = statistics[begin:begin + windows] >= length
            edge = np.flatnonzero(np.diff(np.r_[0, long.view(np.int8), 0]))
            marked = edge.reshape(-1, 2).tolist()
        out.extend((row, start + a, b - a + length - 1) for row, start in places for a, b in marked)
    return out


def _match(length: int):
    """Segments sorted by bucket: one index at a time is in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, segments = None, {}
        for batch in batches:
            found = []
            contents = batch.column(4)
            for i, (b, _, row, start) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                if b != bucket:
                    found.extend(_mark(segments, length))
                    bucket, segments = b, {}
                segments.setdefault(contents[i].as_py(), []).append((row, start))
            yield _span_rows(found)
        yield _span_rows(_mark(segments, length))
    return run


# -- step 5 --------------------------------------------------------------------------

WINDOWS = {"h1": "<u8", "h2": "<u8", "row": "<i8", "pos": "<i8"}


def _deal_windows(parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, held = batch.column(4), []
            for i, (row, start, n) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))):
                data = np.frombuffer(contents[i].as_buffer(), np.uint8)
                at = np.arange(n)
                head, tail = (words.span_hashes(data, at + x, at + x + length // 2) for x in (0, length - length // 2))
                held.append((head, words.mix(head * np.uint64(0xD6E8FEB86659FD93) + tail),
                             np.full(n, row, np.int64), at + start))
            if held:
                h1, h2, row, pos = (np.concatenate([x[k] for x in held]) for k in range(4))
                yield deal.blobs(WINDOWS, {"h1": h1, "h2": h2, "row": row, "pos": pos}, h2, parts)
    return run


def _repeated_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in deal.gathered(WINDOWS, batches):
            order = np.lexsort((c["h1"], c["h2"]))
            new = deal.heads(c["h2"][order], c["h1"][order])
            again = ~new
            again[:-1] |= ~new[1:]
            at = order[again]
            yield pa.RecordBatch.from_arrays([pa.array(c["row"][at]), pa.array(c["pos"][at]),
                                              pa.array(np.full(len(at), length, np.int64))], names=["row", "start", "n"])
    return run


# -- the whole -----------------------------------------------------------------------

def _merge(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Maximal covered ranges [begin, end) of spans."""
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], np.maximum.accumulate((starts + lengths)[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    return np.stack([begin[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]], 1)


REMOVED = "row long, n_removed long, n_spans long, removed array<struct<begin:bigint,end:bigint>>, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranges_of = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.large_string()), "").cast(pa.large_binary())
        out = []
        for i in range(batch.num_rows):
            ranges = _merge(*(np.asarray(batch.column(k)[i].values, np.int64) for k in (2, 3)))
            data, digest, at = memoryview(text[i].as_buffer()), hashlib.sha256(), 0
            for a, b in ranges.tolist():
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            out.append((int((ranges[:, 1] - ranges[:, 0]).sum()), len(ranges),
                        [{"begin": a, "end": b} for a, b in ranges.tolist()], digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], ranges_of), pa.array([o[3] for o in out], pa.string())],
            names=["row", "n_removed", "n_spans", "removed", "kept_sha256"])


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  probe: int = PROBE, key: int = KEY, bucket_bytes: int = BUCKET_BYTES,
                  hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per input row: (id, n_bytes, n_removed, n_spans, kept_sha256, removed,
    has_repeats); ``removed`` lists maximal byte ranges [begin, end)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = common.with_row(common.numbered(docs, [id_col, text_col])).select(F.col(common.ROW).alias("row"), F.col(id_col).cast("long").alias("id"),
                                        F.col(text_col).alias("text"))
    info = common.materialize(base.mapInArrow(_describe, INFO), "texts")
    classes = info.groupBy("c1", "c2").agg(F.min("row").alias("rep"), F.count("*").alias("copies"))

    dealt = deal.shuffle(base.select("text").mapInArrow(_deal_anchors(parts, length, probe), deal.schema(ANCHORS)))
    places = (dealt.mapInArrow(_repeated_anchors, "c1 long, c2 long, pos array<long>")
              .groupBy("c1", "c2").agg(F.collect_list("pos").alias("pos")))
    wanted = places.join(classes, ["c1", "c2"]).select(F.col("rep").alias("row"), "pos")
    texts = common.materialize(base.select("row", "text").join(wanted, "row"), "repeating-texts")

    segments = common.materialize(texts.mapInArrow(_segments(length, probe, key), SEGMENTS), "segments")
    per_anchor = segments.groupBy("anchor").agg(F.count("*").alias("n_segments"), F.sum(F.octet_length("content")).alias("size"))
    hot = common.materialize(per_anchor.filter(F.col("n_segments") > hot_segments).select("anchor"), "hot-anchors")
    any_hot = hot.count() > 0
    size = segments.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    usual = segments.join(hot, "anchor", "left_anti") if any_hot else segments
    usual = (usual.select(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"), "anchor", "row", "start", "content")
             .repartition("bucket").sortWithinPartitions("bucket"))
    spans = usual.mapInArrow(_match(length), SPANS)
    if any_hot:
        split = deal.shuffle(segments.join(hot, "anchor", "left_semi").select("anchor", "row", "start", "n", "content")
                             .mapInArrow(_deal_windows(parts, length), deal.schema(WINDOWS)))
        spans = spans.union(split.mapInArrow(_repeated_windows(length), SPANS))
    spans = spans.groupBy("row").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    cut = texts.select("row", "text").join(spans, "row").select("row", "text", "starts", "ns").mapInArrow(_cut, REMOVED)

    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    nothing = F.expr("CAST(array() AS array<struct<begin:bigint,end:bigint>>)")
    out = info.join(classes, ["c1", "c2"]).join(cut, "row", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n_bytes"),
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.coalesce("removed", nothing)).alias("removed")
    ).withColumn("has_repeats", F.col("n_removed") > 0)
