"""Token ids in bit-packed shard files, written and read by Spark tasks.

Each id takes the minimum number of bits of the vocabulary.  A shard file is::

    magic 8 bytes | bits u32, ids per block u32 | documents u64, ids u64
    document offsets in ids, u64 each (documents + 1)
    block offsets in bytes from the first block, u64 each (blocks + 1)
    blocks: ids packed from the lowest bit up; each block starts at a byte

All numbers are little-endian.  ``Shard`` reads any range of ids by fetching the
blocks that hold it and unpacks them with numpy.  A manifest (a table in the
shared folder) names the valid files in order: a task writes under a name of its
own and lists the file only when it is complete, so attempts that fail leave
nothing that is read.

Defined cases: null text is empty text and gives the end id only; documents are
written in ascending id order, null ids first; rows with the same id stay
separate; further columns are ignored.
"""

from __future__ import annotations

import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

MAGIC = b"BITPACK1"
BLOCK_IDS = 8192
SHARD_IDS = 8_000_000    # a shard ends with the document that reaches so many ids
END_ID = 2


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype("<u4")
    planes = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder if ":" in folder else f"file://{folder}"))


class ShardWriter:
    """Packs ids block by block; memory holds one shard in packed form."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.offsets, self.ends = [0], [0]
        self.payload, self.rest = io.BytesIO(), np.zeros(0, "<u4")

    def add(self, ids: np.ndarray) -> None:
        self.offsets.append(self.offsets[-1] + len(ids))
        self.rest = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        whole = len(self.rest) // self.block_ids * self.block_ids
        for at in range(0, whole, self.block_ids):
            self._block(self.rest[at:at + self.block_ids])
        self.rest = self.rest[whole:]

    def _block(self, ids: np.ndarray) -> None:
        self.payload.write(pack_bits(ids, self.bits))
        self.ends.append(self.payload.tell())

    def write(self, store: fs.FileSystem, path: str) -> tuple[int, int]:
        if len(self.rest):
            self._block(self.rest)
        head = MAGIC + struct.pack("<IIQQ", self.bits, self.block_ids, len(self.offsets) - 1, self.offsets[-1])
        with store.open_output_stream(path) as f:
            f.write(head)
            f.write(np.array(self.offsets, "<u8").tobytes())
            f.write(np.array(self.ends, "<u8").tobytes())
            f.write(self.payload.getbuffer())
        return len(self.offsets) - 1, self.offsets[-1]


class Shard:
    """Random access to a shard file."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        head = self.file.read_at(32, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is not a shard file")
        self.bits, self.block_ids, self.n_docs, self.n_ids = struct.unpack("<IIQQ", head[8:])
        n_blocks = -(-self.n_ids // self.block_ids)
        table = np.frombuffer(self.file.read_at(8 * (self.n_docs + n_blocks + 2), 32), "<u8").astype(np.int64)
        self.offsets, self.ends = table[:self.n_docs + 1], table[self.n_docs + 1:]
        self.first_block = 32 + 8 * len(table)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end), from the blocks that hold them."""
        if end <= start:
            return np.zeros(0, "<u4")
        a, b = start // self.block_ids, -(-end // self.block_ids)
        raw = self.file.read_at(int(self.ends[b] - self.ends[a]), self.first_block + int(self.ends[a]))
        if self.block_ids * self.bits % 8 == 0:      # blocks follow each other without a gap
            out = unpack_bits(raw, min(b * self.block_ids, self.n_ids) - a * self.block_ids, self.bits)
        else:
            out = np.concatenate([
                unpack_bits(raw[self.ends[k] - self.ends[a]:self.ends[k + 1] - self.ends[a]],
                            min((k + 1) * self.block_ids, self.n_ids) - k * self.block_ids, self.bits)
                for k in range(a, b)])
        return out[start - a * self.block_ids:end - a * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.offsets[k]), int(self.offsets[k + 1]))


MANIFEST = "task int, shard int, path string, n_docs long, n_ids long, doc_ids binary, no_id binary"


def _write(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        store, root = open_store(folder)
        task, number = TaskContext.get().partitionId(), 0
        writer, docs = ShardWriter(bits), []

        def close() -> pa.RecordBatch:
            name = f"{task:06d}-{number:06d}-{uuid.uuid4().hex}.bits"
            n_docs, n_ids = writer.write(store, f"{root}/{name}")
            return pa.RecordBatch.from_pylist([{
                "task": task, "shard": number, "path": name, "n_docs": n_docs, "n_ids": n_ids,
                "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
                "no_id": np.array([d is None for d in docs], np.uint8).tobytes()}],
                schema=pa.schema([("task", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                                  ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("no_id", pa.binary())]))

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for first, end, data, offsets in common.text_steps(batch.column(1), tokens.STEP_BYTES):
                ids, bounds = encoder.encode(data, offsets)
                for i in range(first, end):
                    writer.add(np.append(ids[bounds[i - first]:bounds[i - first + 1]], np.uint32(end_id)).astype("<u4"))
                    docs.append(ids_of[i])
                    if writer.offsets[-1] >= shard_ids:
                        yield close()
                        number += 1
                        writer, docs = ShardWriter(bits), []
        if docs:
            yield close()
    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for path, base, raw, none in zip(*(batch.column(k).to_pylist() for k in range(4))):
                shard = Shard(store, f"{root}/{path}")
                doc_ids = np.frombuffer(raw, "<i8")
                crc = np.zeros(shard.n_docs, np.int64)
                step = 64 * shard.block_ids
                at = 0
                while at < shard.n_docs:             # documents in runs of about ``step`` ids
                    to = max(at + 1, int(np.searchsorted(shard.offsets, shard.offsets[at] + step, "right")) - 1)
                    lo, hi = int(shard.offsets[at]), int(shard.offsets[to])
                    if to == at + 1 and hi - lo > step:
                        value = 0
                        for x in range(lo, hi, step):
                            value = zlib.crc32(shard.ids(x, min(x + step, hi)).tobytes(), value)
                        crc[at] = value
                    else:
                        ids = shard.ids(lo, hi).tobytes()
                        for k in range(at, to):
                            crc[k] = zlib.crc32(ids[4 * (shard.offsets[k] - lo):4 * (shard.offsets[k + 1] - lo)])
                    at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64(), mask=np.frombuffer(none, np.uint8) == 1),
                     pa.array(base + shard.offsets[:-1]), pa.array(np.diff(shard.offsets)), pa.array(crc)],
                    names=["id", "start", "n_tokens", "ids_crc32"])
    return run


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all documents in ascending id order to shard files in ``folder``
    (an existing shared folder); returns the stored manifest."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = base.repartitionByRange(parts, "id").sortWithinPartitions("id")
    return common.materialize(ordered.mapInArrow(_write(folder, tokenizer or tokens.default_tokenizer(), end_id, shard_ids),
                                                 MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Per document from the files: (id, start, n_tokens, ids_crc32)."""
    # one row per shard: the only rows that a single task orders
    base = F.coalesce(F.sum("n_ids").over(Window.orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0).cast("long"))
    offsets = manifest.select("task", "shard", "n_ids").withColumn("base", base).select("task", "shard", "base")
    rows = manifest.join(offsets, ["task", "shard"]).select("path", "base", "doc_ids", "no_id").repartition("path")
    return (rows.mapInArrow(_read(folder), "id long, start long, n_tokens long, ids_crc32 long")
            .withColumnRenamed("id", id_col))


def new_folder(spark: SparkSession, name: str = "token-shards") -> str:
    """A fresh folder for shard files below ``spark.checkpoint.dir``."""
    path = common.shared_path(spark, name)
    store, root = open_store(path)
    store.create_dir(root, recursive=True)
    return path
