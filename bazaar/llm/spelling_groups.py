"""Spelling variants: words at one edit, grouped under their most frequent form.

Counting.  Every map task counts the runs of letters of whole texts in a bounded
dictionary and hands on partial counts, which are summed by word.

Candidates by asymmetric q-chunks.  The shorter word of a pair (of equal lengths both)
contributes two disjoint chunks of q = length // 2 code points, its first and its
last q.  One inserted, deleted or replaced code point touches at most one of them.  The
other word contributes positional grams of that length.  A chunk that one edit
preserves keeps its distance from the nearer end, so among the grams within shift one
of a chunk only the first (shift 0) and the last (shift 0 or 1) can meet it, and only
these are sent.  Chunks and grams are joined on (length of the shorter word, which end,
content), and the edit distance is verified in the join's condition, so candidates
that fail never become rows.

Hot grams.  Behind an equal chunk the rests of two words must differ by the same one
edit.  Where more than ``HOT`` words share a chunk, the rest is cut into two chunks by
the same rule and joins the key; a key then fixes three quarters of the word.

Roots.  A word's form is its near word of largest count, if that is at least twice
the word's own count.  Counts double along forms, so pointer jumping ends after
log2(log2(largest count)) joins or so, each stored in the shared folder.

Defined cases: null or empty text has no words; a null id counts as the empty string
in the hash; equal rows count as often as they stand; ties go to the smallest word in
code-point order; further columns are ignored; an empty table gives no rows; whole
texts of any length are counted.  Words of one code point have no near words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

LEAST_POINTS = 5
LEAST_COUNT = 3
DICTIONARY = 300_000     # words that a map task counts before it hands them on
HOT = 64                 # words with an equal chunk beyond which their rests join the key
SLIP = 97

#: Latin-1 byte of every letter of [A-Za-zÀ-ÿ], A-Z lower-cased; else a space.
_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" or b >= 0xC0
                 else 32 for b in range(256))


def letter_runs(text: str) -> list[bytes]:
    """The letter runs as Latin-1; what Latin-1 lacks becomes '?' and thus a space."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def planted_slip(doc_id: int | None) -> Callable[[bytes], bytes]:
    """Deletes a code point of one run in ``SLIP``, by a hash of id and run."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)

    def slip(run: bytes) -> bytes:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % SLIP:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return slip


def _count(rewrite, least_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for k, doc_id in enumerate(ids):
                text = batch.column(1)[k].as_py()
                if not text:
                    continue
                seen = Counter(letter_runs(text))
                change = rewrite(doc_id) if rewrite else None
                for word, n in seen.items():
                    if change:
                        word = change(word)
                    if len(word) >= least_points:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= DICTIONARY:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None,
                least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of enough code points and occurrences.  ``rewrite(id)``
    gives a function that may change the runs of that text."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    partial = base.mapInArrow(_count(rewrite, least_points), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _ends(text: Column, length: Column, q: Column) -> list[Column]:
    """The first and the last ``q`` of ``length`` code points, each with the rest."""
    zero = F.lit(0)
    return [F.struct(F.lit(0).alias("side"), F.substring(text, F.lit(1), q).alias("gram"),
                     F.substring(text, q + 1, F.greatest(length - q, zero)).alias("rest")),
            F.struct(F.lit(1).alias("side"), F.substring(text, length - q + 1, q).alias("gram"),
                     F.substring(text, F.lit(1), F.greatest(length - q, zero)).alias("rest"))]


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


KEY = ["base", "side", "gram"]


def _keys(words: DataFrame, base: Column) -> DataFrame:
    """(word, n, base, side, gram, rest): the ends of every word, q by ``base``, the
    length of the word that gives the chunks."""
    size = F.char_length("word")
    return (words.withColumn("base", F.explode(base)).filter("base > 1")
            .withColumn("end", F.explode(F.array(*_ends(F.col("word"), size, _half(F.col("base"))))))
            .select("word", "n", "base", "end.*"))


def _refined(keys: DataFrame, hot: DataFrame) -> DataFrame:
    """The rest of hot keys cut in two again; other keys stay as they are."""
    rest, left = F.col("rest"), F.col("base") - _half(F.col("base"))
    plain = F.array(F.struct(F.lit(-1).alias("side"), F.lit("").alias("gram"), F.lit("").alias("rest")))
    again = F.when(F.col("hot"), F.array(*_ends(rest, F.char_length(rest), _half(left)))).otherwise(plain)
    return (keys.join(hot, KEY, "left").withColumn("more", F.explode(again))
            .select("word", "n", *KEY, F.col("more.side").alias("side2"), F.col("more.gram").alias("gram2")))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, n_a, b, n_b): every unordered pair of distinct ``words`` (word, n) at one
    edit, once."""
    size = F.char_length("word")
    chunks = _keys(words, F.array(size))
    grams = _keys(words, F.array(size, size - 1))
    heavy = common.materialize(chunks.groupBy(*KEY).count().filter(F.col("count") > hot).select(*KEY, F.lit(True).alias("hot")),
                               "hot-grams")
    left = _refined(chunks, heavy).select(F.col("word").alias("a"), F.col("n").alias("n_a"), *KEY, "side2", "gram2")
    right = _refined(grams, heavy).select(F.col("word").alias("b"), F.col("n").alias("n_b"), *KEY, "side2", "gram2")
    once = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in [*KEY, "side2", "gram2"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return (left.alias("l").join(right.alias("r"), on & once & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "n_a", "b", "n_b").distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by pointer jumping."""
    state = common.materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = common.materialize(state.join(onward, "root", "left").select("word", "root", "next"), "roots")
        if step.filter("next IS NOT NULL").isEmpty():
            return state
        state = step.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``words`` (word, n), distinct -> word, n, n_near, form, form_n, root."""
    words = common.materialize(words.select("word", "n"), "words")
    pairs = common.materialize(near_pairs(words, hot), "near-words")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("form"))).alias("top"))
    with_near = words.join(best, "word", "left")
    frequent = -F.col("top.m") >= 2 * F.col("n")
    table = common.materialize(with_near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("top.form")).alias("form"), F.when(frequent, -F.col("top.m")).alias("form_n")), "forms")
    roots = _roots(table.filter("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """``spelling_groups`` of the words of ``docs``."""
    return spelling_groups(word_counts(docs, id_col, text_col, rewrite))
