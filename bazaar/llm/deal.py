"""Columns of numbers dealt to partitions as packed blobs.

Shuffling one row per text position costs Spark far more than the position's few
bytes.  A task therefore gathers positions in numpy columns and sends each
target partition one row of packed columns; the receiving task puts the columns
together again.  The number of partitions follows the session's setting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PART = "part"


def schema(columns: dict[str, str]) -> str:
    return f"{PART} int, " + ", ".join(f"{c} binary" for c in columns)


def blobs(columns: dict[str, str], values: dict[str, np.ndarray], key: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows (part, packed columns); ``columns`` names the numpy kinds."""
    part = (key >> np.uint64(20)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    used = np.flatnonzero(cut[1:] > cut[:-1])
    out = [pa.array(used, pa.int32())]
    for c, kind in columns.items():
        v = values[c].astype(kind, copy=False)[order]
        out.append(pa.array([v[cut[p]:cut[p + 1]].tobytes() for p in used], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=[PART, *columns])


def gathered(columns: dict[str, str], batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each partition that this task received, one after another."""
    held: dict[int, list[list[bytes]]] = {}
    for batch in batches:
        lists = [batch.column(k).to_pylist() for k in range(1 + len(columns))]
        for p, *packed in zip(*lists):
            held.setdefault(p, []).append(packed)
    for p in list(held):
        rows = held.pop(p)
        yield {c: np.frombuffer(b"".join(r[k] for r in rows), kind) for k, (c, kind) in enumerate(columns.items())}


def shuffle(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), PART)


def heads(*keys: np.ndarray) -> np.ndarray:
    """True where a new group of equal keys begins (keys are sorted)."""
    if not len(keys[0]):
        return np.zeros(0, bool)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new
