"""Bounded-space online packing of token ids into windows of fixed length.

Each partition keeps ``OPEN`` windows.  Whole windows of a long document are
emitted at once; what remains goes into the open window it fits best.  When it
fits none, the fullest window is topped up with its first ids and emitted, and
the rest goes on into a fresh window.  The windows still open at the end of a
partition are written with their ids and packed again by fewer tasks, until one
task fills the last ones; only the very last window is padded.

Every level is a table in the shared folder, so a level never mixes the outputs
of two attempts of a task.  What one task of a later level reads is bounded by
``FAN_IN`` partitions of at most ``OPEN`` windows.

Defined cases: null text is empty text and gives the end id only; rows with null
or repeated ids are packed like any other; further columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

WINDOW = 1024
OPEN = 64      # open windows per partition
FAN_IN = 8     # partitions whose open windows one task of the next level takes
END_ID = 0

PIECES = ("id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary, share int")


class Packer:
    """Open windows of one task.  ``out`` collects emitted pieces."""

    def __init__(self, window: int, n_open: int, first_id: int):
        self.window, self.n_open, self.next_id = window, n_open, first_id
        self.gaps: list[tuple[int, int]] = []        # (free ids, window number), ascending
        self.content: dict[int, list] = {}
        self.made = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset, None, None))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.window:
            self._emit([(doc, start, ids[:self.window], total)])
            start, ids = start + self.window, ids[self.window:]
        while len(ids):
            at = bisect.bisect_left(self.gaps, (len(ids), -1))
            if at == len(self.gaps) and len(self.gaps) < self.n_open:
                self.made += 1
                self.gaps.append((self.window, self.made))
                self.content[self.made] = []
            elif at == len(self.gaps):               # fits none: fill and emit the fullest
                gap, number = self.gaps.pop(0)
                self._emit(self.content.pop(number) + [(doc, start, ids[:gap], total)])
                start, ids = start + gap, ids[gap:]
                continue
            gap, number = self.gaps.pop(at)
            self.content[number].append((doc, start, ids, total))
            if gap == len(ids):
                self._emit(self.content.pop(number))
            else:
                bisect.insort(self.gaps, (gap - len(ids), number))
            return

    def leftovers(self) -> list[tuple]:
        return [piece for number in sorted(self.content) for piece in self.content[number]]

    def finish(self) -> None:
        """Join all open windows to full ones and a last one."""
        rest, room = [], self.window
        for doc, start, ids, total in self.leftovers():
            while len(ids) >= room:
                self._emit(rest + [(doc, start, ids[:room], total)])
                start, ids = start + room, ids[room:]
                rest, room = [], self.window
            if len(ids):
                rest.append((doc, start, ids, total))
                room -= len(ids)
        if rest:
            self._emit(rest)
        self.content = {}


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                      names=[c.split()[0] for c in PIECES.split(", ")])


def _left(packer: Packer, share: int) -> pa.RecordBatch:
    return _rows([(doc, start, len(ids), None, total, None, None, ids.tobytes(), share)
                  for doc, start, ids, total in packer.leftovers()])


def _first_id(level: int) -> int:
    return level << 56 | TaskContext.get().partitionId() << 32


def _pack_texts(tokenizer: str, window: int, n_open: int, step_bytes: int, memo_pieces: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, memo_pieces)
        packer = Packer(window, n_open, _first_id(0))
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for first, end, data, offsets in common.text_steps(batch.column(1), step_bytes):
                ids, bounds = encoder.encode(data, offsets)
                for i in range(first, end):
                    own = np.append(ids[bounds[i - first]:bounds[i - first + 1]], np.uint32(END_ID))
                    packer.add(docs[i], 0, own.astype("<u4"), len(own))
                if packer.out:
                    yield _rows(packer.out)
                    packer.out = []
        yield _left(packer, TaskContext.get().partitionId() // FAN_IN)
    return run


def _pack_again(level: int, last: bool, window: int, n_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, share = Packer(window, n_open, _first_id(level)), 0
        for batch in batches:
            for doc, start, total, ids, share in zip(*(batch.column(k).to_pylist() for k in range(5))):
                packer.add(doc, start, np.frombuffer(ids, "<u4"), total)
            yield _rows(packer.out)
            packer.out = []
        if last:
            packer.finish()
            yield _rows(packer.out)
        else:
            yield _left(packer, share // FAN_IN)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         window: int = WINDOW, n_open: int = OPEN, step_bytes: int = tokens.STEP_BYTES,
         memo_pieces: int | None = None) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).
    Smaller steps and a smaller memo of the encoder take less memory and more time."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = _pack_texts(tokenizer or tokens.default_tokenizer(), window, n_open, step_bytes, memo_pieces)
    table = common.materialize(base.mapInArrow(common.lean(texts), PIECES), "packed-0")
    done = [table.filter("share IS NULL")]
    level = 0
    while True:
        level += 1
        left = table.filter("share IS NOT NULL")
        shares = (left.agg(F.max("share")).first()[0] or 0) + 1
        items = left.select("id", "start", "doc_tokens", "ids", "share")
        # the k-th share goes to the k-th task
        items = items.repartitionByRange(shares, "share") if shares > 1 else items.coalesce(1)
        table = common.materialize(items.sortWithinPartitions("share", "id", "start")
                                   .mapInArrow(common.lean(_pack_again(level, shares == 1, window, n_open)), PIECES), f"packed-{level}")
        done.append(table.filter("share IS NULL"))
        if shares == 1:
            break
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
