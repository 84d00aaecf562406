"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic).  A cell's weight is its share of
tokens times one factor per category of each dimension, and at most a bound.  Fitting
takes the dimensions in turn: the weights are summed by category (partial sums, so a
category with a third of all cells is no hot key) and each category's factor is moved
towards its target.  The cells are stored in as many partitions as their number needs.

First the weights are raked to the targets without bounds.  A document is kept with
the probability of its cell, such that the expected share of tokens kept is
``KEEP_SHARE``: ``c * weight / tokens`` where no cell needs more than all its tokens.
Otherwise the tokens to keep are raked again with each cell's tokens as bound, so that
other cells make up for the full ones and the kept tokens still have the target
marginals; a factor's step then counts what full cells hold as given.  A category
whose target exceeds all its tokens is kept whole, and the rest of its dimension
shares what it lacks in proportion to the targets; ``reached`` gives target and
expected share of every category.  The draw is a hash of the id, so it is the same
at every run.

Fitting ends when every marginal is within ``TOLERANCE`` of its target.  Targets that
exclude each other can't be met: the largest difference then all but stops shrinking (or
``MAX_ROUNDS`` are over), fitting ends there, and column ``difference`` says how far
the marginals are off.

The topic of a document is the vocabulary slice (hash of words of four bytes and
more, modulo ``TOPICS``) that it uses most compared with the whole corpus.  Tokens
are counted as words.

Targets default to the corpus's own marginals to the power ``ALPHA``, normed,
which lowers what dominates and raises what is rare.

Defined cases: null source or language is a category of its own (empty string);
a text without long words has topic -1; null or empty text has no tokens, doesn't
count in any marginal and has its cell's probability; rows with a null id are
drawn by row number; cells whose target is zero are never kept; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, words

TOPICS = 8
ALPHA = 0.7
KEEP_SHARE = 0.75
TOLERANCE = 1e-5      # largest difference of a marginal share
MAX_ROUNDS = 60       # the difference that is left then is returned
PATIENCE = 5          # rounds in which the difference shrinks by under 2 %: targets exclude each other
CELLS_PER_TASK = 200_000
CELL_FILES = 32       # files of the table of cells before its rows are counted
DIMENSIONS = ("source", "lang", "topic")


def _profile(topics: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.text_steps(batch.column(4)):
                low = words._LOWER[data]
                starts, ends, doc = words.word_bounds(low, offsets)
                n = len(offsets) - 1
                count = np.bincount(doc, minlength=n)
                long = ends - starts >= 4
                h = words.hash_spans(low, starts[long], ends[long]) % np.uint64(topics)
                grid = np.bincount(doc[long] * topics + h.astype(np.int64), minlength=n * topics)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(first, end - first) for k in range(4)]
                    + [pa.array(count, pa.int64()),
                       pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * topics, pa.int32()), pa.array(grid, pa.int64()))],
                    names=["row", "id", "source", "lang", "n_tokens", "slices"])
    return run


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topics: int = TOPICS) -> DataFrame:
    """(row, id, source, lang, n_tokens, topic) of every row, stored."""
    base = common.with_row(docs).select(
        F.col(common.ROW).alias("row"), F.col(id_col).cast("long").alias("id"),
        F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.col(text_col).alias("text"))
    kinds = "row long, id long, source string, lang string, n_tokens long, slices array<long>"
    table = common.materialize(base.mapInArrow(common.lean(_profile(topics)), kinds), "profiles")
    corpus = table.agg(*[F.sum(F.col("slices")[k]).alias(f"s{k}") for k in range(topics)]).first()
    # lift of a slice: its count here over its count in the corpus; the first largest wins
    lift = F.array(*[F.col("slices")[k] / F.lit(float(max(corpus[k] or 0, 1))) for k in range(topics)])
    topic = F.when(F.aggregate("slices", F.lit(0).cast("long"), lambda a, x: a + x) > 0,
                   F.array_position(lift, F.array_max(lift)).cast("int") - 1).otherwise(F.lit(-1))
    return table.withColumn("topic", topic).drop("slices")


def default_targets(cells: DataFrame, dimension: str, alpha: float = ALPHA) -> DataFrame:
    """(dimension, target): token shares to the power alpha, normed."""
    power = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(alpha)).alias("p"))
    return power.select(dimension, (F.col("p") / power.agg(F.sum("p")).scalar()).alias("target"))


def _compact(df: DataFrame, rows: int, name: str) -> DataFrame:
    """``df`` stored in partitions of about ``CELLS_PER_TASK`` of its ``rows``."""
    parts = max(1, math.ceil(rows / CELLS_PER_TASK))
    return common.materialize(df.coalesce(parts), name).coalesce(parts)


def _fit(cells: DataFrame, targets: dict[str, DataFrame], rows: int, tolerance: float, max_rounds: int
         ) -> tuple[DataFrame, float]:
    """``cells`` (with base and bound) with ``free``, the fitted weight without bound, and
    the largest difference of a marginal that is left.

    A step sets a category's factor so that its cells reach the target if the full
    ones stay full and the others grow alike; if the full ones alone exceed the target
    all are scaled down.  Sums rise ever slower in the factor, so such steps come to
    the target from below.  The cells carry the product of their factors, so a step is
    one sum by category and one join; the cells of the step before are removed."""
    spark, full = cells.sparkSession, F.col("free") >= F.col("bound")
    state = cells.withColumn("free", F.col("base"))
    for d, target in targets.items():
        state = state.join(target.select(d, F.col("target").alias(f"__{d}")), d, "left").fillna(0.0, [f"__{d}"])
        state = state.withColumn(f"__off_{d}", F.lit(0.0))
    least, left, waited, path = math.inf, 0.0, 0, None
    for _ in range(max_rounds):
        for d in targets:
            now, goal = F.col("held") + F.col("moving"), F.col("goal")
            sums = state.groupBy(d).agg(
                F.sum(F.when(full, F.col("bound")).otherwise(0.0)).alias("held"),
                F.sum(F.when(full, 0.0).otherwise(F.col("free"))).alias("moving"), F.first(f"__{d}").alias("goal"))
            step = (F.when((goal > F.col("held")) & (F.col("moving") > 0), (goal - F.col("held")) / F.col("moving"))
                    .when(now > 0, goal / now).otherwise(0.0))
            moved = state.drop(f"__off_{d}").join(sums.select(d, step.alias("__step"), F.abs(now - goal).alias(f"__off_{d}")), d)
            state = _compact(moved.withColumn("free", F.col("free") * F.col("__step")).drop("__step"), rows, "state")
            if path:
                common.remove(spark, path)
            path = common.last_path()
        left = state.agg(F.max(F.greatest(*[F.col(f"__off_{d}") for d in targets], F.lit(0.0)))).first()[0] or 0.0
        common.free_shuffles(spark)
        waited = 0 if left < 0.98 * least else waited + 1
        least = min(least, left)
        if left < tolerance or waited == PATIENCE:
            break
    return state.select(*cells.columns, "free"), left


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens > 0) with ``weight``: shares whose marginals are the
    targets, and the ``difference`` that is left.  A category without a target has the
    target zero."""
    rows, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    if not total:
        return cells.withColumns({"weight": F.lit(0.0), "difference": F.lit(0.0)})
    stored = _compact(cells.withColumns({"base": F.col("tokens") / F.lit(float(total)), "bound": F.lit(math.inf)}), rows, "cells")
    fitted, left = _fit(stored, targets, rows, tolerance, max_rounds)
    return fitted.select(*cells.columns, F.col("free").alias("weight"), F.lit(left).alias("difference"))


def rebalance(cells: DataFrame, targets: dict[str, DataFrame], keep_share: float = KEEP_SHARE,
              tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (with ``weight`` and ``difference`` by ``rake``) with ``part``: shares of
    the kept tokens, none above the cell's own tokens, whose marginals are the targets
    as far as the categories have the tokens."""
    rows, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    keep = float(total or 0) * keep_share
    if not keep or not cells.filter(F.col("weight") * F.lit(keep) > F.col("tokens")).take(1):
        return cells.withColumn("part", F.col("weight"))
    goals = {}
    for d, target in targets.items():
        there = _compact(cells.filter("weight > 0").groupBy(d).agg(F.sum("tokens").alias("tokens")).join(
            target.withColumnRenamed("target", "weight"), d), rows, "targets")
        goal = probabilities(there, keep / there.agg(F.sum("tokens")).first()[0])
        goals[d] = goal.select(d, (F.col("probability") * F.col("tokens") / F.lit(keep)).alias("target"))
    stored = _compact(cells.withColumns({"base": F.col("weight"), "bound": F.col("tokens") / F.lit(keep)}), rows, "cells")
    fitted, left = _fit(stored, goals, rows, tolerance, max_rounds)
    kept = fitted.withColumn("part", F.least("free", "bound"))
    return kept.withColumn("difference", F.greatest("difference", F.lit(left))).select(*cells.columns, "part")


def probabilities(cells: DataFrame, keep_share: float = KEEP_SHARE, by: str = "weight") -> DataFrame:
    """Cells with ``probability`` = min(1, c * weight / tokens), ``c`` solved so that
    the expected tokens are ``keep_share`` of all (or all that is reachable).  ``by``
    names the column of weights.  Each step gives the cells that aren't full what the
    full ones leave; ``c`` only grows, and with it the set of full cells."""
    total, weights = cells.agg(F.sum("tokens"), F.sum(by)).first()
    if not total or not weights:
        return cells.withColumn("probability", F.lit(0.0))
    keep, weight = keep_share * total, F.col(by)
    c = keep / weights
    while True:
        full = weight * F.lit(c) >= F.col("tokens")
        held, moving = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(weight))).first()
        grown = (keep - held) / moving if moving and keep > held else c
        if grown <= c * (1 + 1e-12):
            return cells.withColumn("probability", F.least(F.lit(1.0), weight * F.lit(c) / F.col("tokens")))
        c = grown


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", targets: dict[str, DataFrame] | None = None,
        keep_share: float = KEEP_SHARE, seed: int = 17) -> DataFrame:
    """One row per input row: row, id, source, lang, topic, n_tokens, weight (of the
    cell), probability, kept, difference (of the fitted marginals from the targets).
    ``targets``: per dimension a frame (dimension, target)."""
    table = profiles(docs, id_col, text_col)
    dims = list(DIMENSIONS)
    cells = common.materialize(table.groupBy(*dims).agg(F.sum("n_tokens").alias("tokens")).coalesce(CELL_FILES), "cells")
    rows = cells.count()
    full = _compact(cells.filter("tokens > 0"), rows, "cells")
    goal = {d: _compact(t, rows, "targets") for d, t in (targets or {d: default_targets(full, d) for d in dims}).items()}
    raked = _compact(rebalance(_compact(rake(full, goal), rows, "raked"), goal, keep_share), rows, "raked")
    fitted = _compact(probabilities(raked, keep_share, "part"), rows, "probabilities")
    draw = F.pmod(F.xxhash64(F.coalesce("id", -F.col("row") - 1), F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (table.join(fitted.select(*dims, "weight", "probability", "difference"), dims, "left")
            .fillna(0.0, ["weight", "probability", "difference"])
            .withColumn("kept", draw < F.col("probability"))
            .select("row", F.col("id").alias(id_col), *dims, "n_tokens", "weight", "probability", "kept", "difference"))


def reached(mixed: DataFrame) -> DataFrame:
    """Of a result of ``mix``: per dimension and category the share of tokens before,
    the target (marginal of the weights) and the expected share of the kept tokens."""
    cells = mixed.filter("n_tokens > 0").groupBy(*DIMENSIONS).agg(
        F.sum("n_tokens").alias("n"), F.first("weight").alias("w"), F.sum(F.col("n_tokens") * F.col("probability")).alias("k"))
    whole = cells.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("category"), "n", "w", "k") for d in DIMENSIONS])).alias("x"))
    sums = whole.select("x.*").groupBy("dimension", "category").agg(*[F.sum(c).alias(c) for c in "nwk"])
    one = Window.partitionBy("dimension")
    return sums.select("dimension", "category", *[(F.col(c) / F.sum(c).over(one)).alias(name)
                                                  for c, name in zip("nwk", ("share", "target", "expected"))])


def sample_mix(docs: DataFrame, **kwargs) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    spark, stored = docs.sparkSession, common.numbered(docs)
    lost = common.settled(spark, common.shared_path(spark, "not-drawn"),
                          lambda: mix(stored, **kwargs).filter("NOT kept").select("row"))
    return common.without_rows(stored, lost)
