"""Matrix sums over many columns: pairwise moments and distributed QR.

A task keeps one set of sums (or one triangular factor) for all its rows, in numpy;
what the tasks hand on is merged in a tree of ``FAN_IN`` partial results a node, so
neither the rows nor all partial results meet in one place.  Only a result whose size
is set by the number of columns reaches the driver.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

FAN_IN = 32
BLOCK = 64           # rows of the column-by-column matrices in one partial result
PARTIAL = "slot int, block int, data binary"

Arrays = list[np.ndarray]


def _pack(arrays: Arrays) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a)
    return out.getvalue()


def _unpack(data: bytes) -> Arrays:
    src, out = io.BytesIO(data), []
    while src.tell() < len(data):
        out.append(np.load(src))
    return out


def _row(slot: int, block: int, arrays: Arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([block], pa.int32()),
                                       pa.array([_pack(arrays)], pa.binary())], names=["slot", "block", "data"])


def _tree(partials: DataFrame, merge: Callable[[int, Arrays, Arrays], Arrays]) -> dict[int, Arrays]:
    """The merged arrays of every block of ``partials`` (slot, block, data)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], Arrays] = {}
        for batch in batches:
            for slot, block, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                now = _unpack(data)
                held[slot, block] = merge(block, held[slot, block], now) if (slot, block) in held else now
        for (slot, block), arrays in held.items():
            yield _row(slot, block, arrays)

    level = cut_lineage(partials)
    top = level.agg(F.max("slot")).first()[0]
    while top:
        top //= FAN_IN
        level = (level.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
                 .repartition("slot", "block").mapInArrow(run, PARTIAL))
    return {r.block: _unpack(bytes(r.data)) for r in level.collect()}


def _columns(batch: pa.RecordBatch, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(values as columns of doubles, 0 at nulls; 1 where there is a value)."""
    cols = [batch.column(k) for k in range(first, batch.num_columns)]
    there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cols], 1)
    values = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cols], 1)
    return values, there.astype(float)


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.spark_partition_id().alias("slot"),
                     *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def pairwise_moments(df: DataFrame, columns: Sequence[str]) -> tuple[Arrays, np.ndarray]:
    """For all pairs (i, j) of columns, over the rows where both have a value:
    [n, sum of x_i, sum of x_j, sum of x_i squared, sum of x_i x_j], of values less
    the returned shift of their column.  One pass.

    Each task shifts a column by its first value there, which keeps the sums small
    (and those of a constant column exactly zero); merging brings sums to one shift."""
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, sums, shift, known = 0, [np.zeros((k, k)) for _ in range(5)], np.zeros(k), np.zeros(k, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            slot = batch.column(0)[0].as_py()
            x, m = _columns(batch, 1)
            for c in np.flatnonzero(~known & m.any(axis=0)):
                shift[c], known[c] = x[np.argmax(m[:, c]), c], True
            x = np.where(m > 0, x - shift, 0.0)
            xm = x.T @ m
            for s, new in zip(sums, (m.T @ m, xm, xm.T, (x * x).T @ m, x.T @ x)):
                s += new
        for b, at in enumerate(range(0, k, BLOCK)):
            yield _row(slot, b, [shift, known, *[s[at:at + BLOCK] for s in sums]])

    def moved(block: int, part: Arrays, shift: np.ndarray) -> Arrays:
        n, a, b, aa, ab = part[2:]
        d = np.where(part[1], part[0] - shift, 0.0)
        di, dj = d[block * BLOCK:block * BLOCK + len(n), None], d[None, :]
        return [n, a + n * di, b + n * dj, aa + 2 * di * a + n * di * di, ab + dj * a + di * b + n * di * dj]

    def merge(block: int, x: Arrays, y: Arrays) -> Arrays:
        shift = np.where(x[1], x[0], y[0])
        return [shift, x[1] | y[1], *[s + t for s, t in zip(moved(block, x, shift), moved(block, y, shift))]]

    blocks = _tree(_doubles(df, columns).mapInArrow(run, PARTIAL), merge)
    if not blocks:
        return [np.zeros((k, k)) for _ in range(5)], np.zeros(k)
    whole = [blocks[b] for b in sorted(blocks)]
    # rows of different blocks may have been brought to different shifts
    shift = whole[0][0]
    parts = [moved(b, x, shift) for b, x in enumerate(whole)]
    return [np.concatenate([p[i] for p in parts]) for i in range(5)], shift


def correlations(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlations of all pairs over their common rows: NaN where one of the
    two doesn't vary there, infinite where fewer than two rows are common."""
    (n, a, b, aa, ab), _ = pairwise_moments(df, columns)
    with np.errstate(all="ignore"):
        var = aa - a * a / n
        var = np.where(var <= 1e-12 * aa, 0.0, var)          # what rounding leaves of a constant
        out = (ab - a * b / n) / np.sqrt(var * var.T)
    return np.where(n < 2, np.inf, np.where(np.isfinite(out), np.clip(out, -1, 1), np.nan))


def triangular_factor(df: DataFrame, columns: Sequence[str], centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of the rows of ``columns`` (without nulls), less
    ``centre`` and divided by ``scale``: every task factors its rows step by step, and
    factors are stacked and factored again up the tree (TSQR).  R' R is the matrix of
    products, but R keeps the digits that forming products loses."""
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, r = 0, np.zeros((0, k))
        for batch in batches:
            if batch.num_rows:
                slot = batch.column(0)[0].as_py()
                r = np.linalg.qr(np.vstack([r, (_columns(batch, 1)[0] - centre) / scale]), mode="r")
        yield _row(slot, 0, [r])

    merged = _tree(_doubles(df, columns).mapInArrow(run, PARTIAL),
                   lambda _, x, y: [np.linalg.qr(np.vstack([x[0], y[0]]), mode="r")])
    return merged[0][0]


def poisson_draws(keys: np.ndarray, replicates: int) -> np.ndarray:
    """(rows, replicates) draws from Poisson(1), each a function of the row's 64-bit
    ``key`` and the replicate's number: a hash as a uniform number, inverted."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64)[:, None] + np.arange(1, replicates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    u = (h >> np.uint64(11)).astype(float) / float(1 << 53)
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(19)])
    return np.searchsorted(steps, u, "right").astype(np.int8)


ROWS_AT_ONCE = 2048


def poisson_sums(d: DataFrame, replicates: int, centre_x: float, centre_y: float) -> np.ndarray:
    """``d`` (h, x, y) -> (5, replicates): sums of the drawn weights w, w x, w y, w x^2
    and w x y of every replicate, of values less their centres."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, total = 0, np.zeros((5, replicates))
        for batch in batches:
            slot = batch.column(0)[0].as_py() if batch.num_rows else slot
            keys, x, y = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            x, y = x - centre_x, y - centre_y
            columns = np.stack([np.ones(len(x)), x, y, x * x, x * y])
            for at in range(0, len(x), ROWS_AT_ONCE):
                some = slice(at, at + ROWS_AT_ONCE)
                total += columns[:, some] @ poisson_draws(keys[some].view(np.uint64), replicates)
        yield _row(slot, 0, [total])

    placed = d.select(F.spark_partition_id().alias("slot"), "h", "x", "y")
    return _tree(placed.mapInArrow(run, PARTIAL), lambda _, a, b: [a[0] + b[0]])[0][0]
