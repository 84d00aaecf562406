"""Quality rules with an isolation forest on rule statistics.

Counts of whole texts give ratios (symbols per word, upper-case share, ...).  A
rule is one side of one ratio; how far a document lies beyond the range of
labelled good documents is its value for the rule, and zero inside the range.
Random splits on these values isolate a document the sooner, the stranger it
is; the mean path length gives a score in (0, 1).  Documents above the score
threshold, and those that fail the two fixed base rules, are rejected.

Fitted on at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their id: one half gives ranges, rules and trees, the other half the threshold.
Everything else covers all rows of the table.

Defined cases: null text is empty (no words, so the base rule rejects it); a
document labelled twice is good only if all its labels are; null labels don't
count; without labelled rows of both kinds only the base rules reject; rows with
a null or repeated id are judged one by one; further columns are ignored by
``quality_rules`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, rule_stats

FIT_ROWS = 20_000
TREES = 100
TREE_ROWS = 256
RANGE = 0.005        # share of good rows outside a rule's range on either side
MARGIN = 1.0         # of the distance from median to limit, that a rule leaves free beyond the limit
MIN_SHARE, MIN_LIFT = 0.05, 3.0   # a rule is used if it meets so many bad rows, and so many times the good ones
FALSE_REJECT_COST = 10.0          # of a good document, against missing a bad one
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_COUNTS = rule_stats.BASE + rule_stats.EXTRA


def ratios(s: dict[str, np.ndarray]) -> np.ndarray:
    """The statistics as a (rows, ratios) matrix."""
    n = np.maximum(s["n_words"], 1)
    return np.stack([
        s["word_chars"] / n, s["n_symbols"] / n, s["n_symbol_words"] / n, s["n_dup_lines"] / np.maximum(s["n_lines"], 1),
        s["n_repeat_words"] / n, s["n_upper"] / np.maximum(s["n_alpha"], 1), s["n_alpha"] / np.maximum(s["n_bytes"], 1),
        s["n_digits"] / np.maximum(s["n_bytes"], 1), s["n_distinct_words"] / n, s["n_bangs"] / n], axis=1)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


@dataclass
class QualityModel:
    """Rule ranges, trees and threshold; a few hundred KB at most."""

    column: np.ndarray     # ratio of each rule
    side: np.ndarray       # +1: above the range, -1: below it
    limit: np.ndarray
    scale: np.ndarray
    trees: list            # per tree: feature, split, left, right, path length at leaves
    cut: float

    def values(self, r: np.ndarray) -> np.ndarray:
        return np.log1p(np.maximum(0.0, self.side * (r[:, self.column] - self.limit) / self.scale - MARGIN))

    def score(self, r: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(r))
        x, total = self.values(r), np.zeros(len(r))
        row = np.arange(len(x))
        for feature, split, left, right, path in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                at = np.where(inner, np.where(x[row, feature[at]] < split[at], left[at], right[at]), at)
            total += path[at]
        return 2.0 ** (-total / (len(self.trees) * _mean_path(TREE_ROWS)))


def _mean_path(n: int) -> float:
    """Expected path length of an unsuccessful search among n rows."""
    if n <= 2:
        return float(max(n - 1, 0))
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _tree(x: np.ndarray, rng: np.random.Generator, depth: int) -> tuple[np.ndarray, ...]:
    nodes: list[list] = []

    def grow(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, level + _mean_path(len(rows))])
        if level < depth and len(rows) > 1:
            low, high = rows.min(axis=0), rows.max(axis=0)
            free = np.flatnonzero(high > low)
            if len(free):
                f = int(rng.choice(free))
                split = float(rng.uniform(low[f], high[f]))
                less = rows[:, f] < split
                if less.any() and not less.all():
                    nodes[at] = [f, split, grow(rows[less], level + 1), grow(rows[~less], level + 1), 0.0]
        return at

    grow(x, 0)
    return tuple(np.array([n[k] for n in nodes]) for k in range(5))


def fit_arrays(r: np.ndarray, good: np.ndarray, seed: int = 7) -> QualityModel:
    """Fit on ratios of labelled rows; every second row calibrates the threshold."""
    none = QualityModel(*(np.zeros(0, np.int64),) * 2, np.zeros(0), np.ones(0), [], math.inf)
    fit = np.arange(len(r)) % 2 == 0
    if min((good & fit).sum(), (~good & fit).sum(), (good & ~fit).sum(), (~good & ~fit).sum()) == 0:
        return none
    low, mid, high = np.quantile(r[good & fit], [RANGE, 0.5, 1 - RANGE], axis=0)
    k = r.shape[1]
    model = QualityModel(np.tile(np.arange(k), 2), np.repeat([1, -1], k), np.concatenate([high, low]),
                         np.maximum(np.concatenate([high - mid, mid - low]), 0.01), [], math.inf)
    beyond = model.values(r) > 0
    share_bad, share_good = beyond[~good & fit].mean(axis=0), beyond[good & fit].mean(axis=0)
    use = (share_bad >= MIN_SHARE) & (share_bad >= MIN_LIFT * share_good)
    if not use.any():
        return none
    model.column, model.side, model.limit, model.scale = (v[use] for v in (model.column, model.side, model.limit, model.scale))
    rng, x = np.random.default_rng(seed), model.values(r)[fit]
    depth = math.ceil(math.log2(TREE_ROWS))
    model.trees = [_tree(x[rng.choice(len(x), min(TREE_ROWS, len(x)), replace=False)], rng, depth) for _ in range(TREES)]
    score, ok = model.score(r[~fit]), good[~fit]
    levels = np.unique(score)
    cuts = np.concatenate([(levels[:-1] + levels[1:]) / 2, [math.inf]])
    caught = 1 - np.searchsorted(np.sort(score[~ok]), cuts) / (~ok).sum()
    lost = 1 - np.searchsorted(np.sort(score[ok]), cuts) / ok.sum()
    model.cut = float(cuts[np.argmax(caught - FALSE_REJECT_COST * lost)])
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in common.text_steps(batch.column(2)):
            s = rule_stats.statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).slice(first, end - first) for k in (0, 1)] + [pa.array(s[c], pa.int64()) for c in _COUNTS],
                names=["row", "id", *_COUNTS])


def _arrays(batch: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch)
            else batch.column(c).to_numpy() for c in _COUNTS}


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, counts...) of every row of ``docs``, stored in the shared folder."""
    base = common.with_row(docs).select(common.ROW, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return common.materialize(base.mapInArrow(common.lean(_count), "row long, id long, " + ", ".join(f"{c} long" for c in _COUNTS)),
                              "rule-statistics")


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """``labels``: (doc_id, quality 0/1).  Base failures are not fitted."""
    marks = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality")))
    passed = stats.filter(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT_PERCENT} * n_words")
    sample = passed.join(marks, "id").orderBy(F.xxhash64("id"), "id", "row").limit(fit_rows).toArrow()
    return fit_arrays(ratios(_arrays(sample)), sample.column("quality").to_numpy() == 1)


def verdicts(stats: DataFrame, model: QualityModel) -> DataFrame:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _arrays(batch)
            failed, score = base_failed(s), model.score(ratios(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id")] + [batch.column(c) for c in rule_stats.BASE]
                + [pa.array(failed), pa.array(~failed & ~(score > model.cut)), pa.array(score)],
                names=["row", "id", *rule_stats.BASE, "base_failed", "kept", "score"])

    return stats.mapInArrow(common.lean(judge), "row long, id long, " + ", ".join(f"{c} long" for c in rule_stats.BASE)
                            + ", base_failed boolean, kept boolean, score double")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row number, id, base counts, base_failed, kept, score."""
    stats = document_statistics(docs, id_col, text_col)
    return verdicts(stats, fit(stats, labels)).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without rejected rows; all columns stay."""
    spark, stored = docs.sparkSession, common.numbered(docs)
    lost = common.settled(spark, common.shared_path(spark, "rejected"), lambda: quality_rules(
        stored, labels, id_col, text_col).filter("NOT kept").select("row"))
    return common.without_rows(stored, lost)
