"""Secret scans: a random forest removes false positives among candidates.

Candidates are runs of 16 and more letters, digits and ``+ / _ - =``.  The forest sees
what a candidate is made of and stands between: its length, the share of every change
from one character class to another, shares of digits and of vowels, the share of its
four-letter pieces that the corpus's own frequent words hold (dictionary coverage),
whether it looks like a path, and the words before and after it, hashed.

It learns from labelled findings and scores every candidate.  They are a frame
(candidate features, ``label`` 0/1).  Without one, ``context_labels`` marks findings by
what the forest doesn't see, the signs around the candidate: a quoted value assigned to a
credential's name is real; a candidate in running prose, neither named, assigned nor
quoted nor in brackets, is none; all others are unlabelled.  So the forest carries what labelled
findings look like over to those without such signs, and may overrule a label.  At most
``FIT_ROWS`` labelled rows, those with the smallest hash, train it; everything else covers
all rows.  ``held_out`` measures precision and recall on findings kept from training.

The dictionary holds words with at least ``DICTIONARY_SHARE`` of all word uses (and two
uses), so it means the same at every corpus size.

Only DataFrame functions and ``pyspark.ml`` are used: nothing runs in Python on
the executors.

Defined cases: null and empty texts have no candidates; with no labelled rows of
both kinds the probability is null and no finding is a secret; rows with null or
repeated ids keep their candidates; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_LENGTH = 16
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 30, 6, 11
DICTIONARY_SHARE = 5e-6  # of all word uses: words of the dictionary
NEIGHBOURS = 64          # hashed values of the words before and after a candidate
GRAM = 4
#: Names that credentials are given to.
CREDENTIAL_NAMES = ["token", "key", "apikey", "secret", "password", "passwd", "credential", "auth"]

CLASSES = {"l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789", "s": "+/_=-"}
CHANGES = [x + y for x in CLASSES for y in CLASSES if x != y]
NUMBERS = ["n_chars", "digit_share", "vowel_share", "upper_share", "coverage", "is_path", *[f"change_{c}" for c in CHANGES]]
WORDS = ["word_before", "word_after"]
FEATURES = [*NUMBERS, *WORDS]
SIGNS = ["named_before", "assigned", "quoted", "in_prose"]
_RUN = r"[A-Za-z0-9+/_=\-]{%d,}" % MIN_LENGTH


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word, candidate, token, before, before2, after): one row per candidate."""
    # cheap test first: most texts and most words hold no candidate at all
    found = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("__t"))
             .filter(F.col("__t").rlike(_RUN)).select("id", F.split("__t", r"\s+").alias("w")))
    spots = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).rlike(_RUN))
    found = found.withColumn("word", F.explode(spots)).select(
        "id", "word", F.get("w", F.col("word")).alias("token"),
        F.coalesce(F.get("w", F.col("word") - 1), F.lit("")).alias("before"),
        F.coalesce(F.get("w", F.col("word") - 2), F.lit("")).alias("before2"),
        F.coalesce(F.get("w", F.col("word") + 1), F.lit("")).alias("after"))
    return found.withColumn("candidate", F.explode(F.regexp_extract_all("token", F.lit(f"({_RUN})"), F.lit(1))))


def dictionary_grams(docs: DataFrame, text_col: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """Four-letter pieces of the lower-case words with a share of all word uses."""
    word = F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+"))
    used = common.materialize(docs.select(word.alias("w")).filter(F.length("w") >= GRAM).groupBy("w").agg(F.count("*").alias("n")),
                              "word-uses")
    total = used.agg(F.sum("n")).first()[0] or 0
    used = used.filter(F.col("n") >= max(2.0, share * total))
    pieces = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - GRAM + 1), lambda i: F.substring("w", i, F.lit(GRAM))))
    return used.select(pieces.alias("gram")).distinct()


def _coverage(found: DataFrame, grams: DataFrame) -> DataFrame:
    """(candidate, coverage) of the distinct candidates."""
    names = found.select("candidate").distinct()
    pieces = names.select("candidate", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("candidate") - GRAM + 1),
        lambda i: F.substring(F.lower("candidate"), i, F.lit(GRAM)))).alias("gram"))
    hit = pieces.join(grams.withColumn("hit", F.lit(1)), "gram", "left")
    return hit.groupBy("candidate").agg((F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")).alias("coverage"))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidates with FEATURES, and with the SIGNS around them that labels come from."""
    found = common.materialize(candidates(docs, id_col, text_col), "candidates")
    cover = _coverage(found, dictionary_grams(docs, text_col))
    c, n = F.col("candidate"), F.length("candidate").cast("double")

    def share(pattern):
        return F.length(F.regexp_replace(c, pattern, "")) / n

    def plain(column):
        return F.regexp_replace(F.lower(column), r"[^\p{L}]", "")

    kinds = F.translate(c, "".join(CLASSES.values()), "".join(k * len(v) for k, v in CLASSES.items()))
    own_lead = F.expr("substring_index(token, candidate, 1)")     # of the same word, before the candidate
    name = F.lower(F.concat_ws(" ", "before2", "before", own_lead))
    named = F.lit(False)
    for word in CREDENTIAL_NAMES:
        named = named | name.contains(word)
    lead = F.concat("before", own_lead)
    bare = F.regexp_replace("token", r"[.,;:!?]+$", "") == c
    prose = bare & F.col("before").rlike(r"^[\p{L}]+[,;]?$") & F.col("after").rlike(r"^[\p{L}]+[.,;:!?]*$")
    out = found.join(cover, "candidate").withColumn("kinds", kinds)
    out = out.withColumns({f"change_{x}": F.regexp_count("kinds", F.lit(x)) / (n - 1) for x in CHANGES})
    return out.withColumns({
        "n_chars": n, "digit_share": share("[^0-9]"), "vowel_share": share("[^aeiouAEIOU]"), "upper_share": share("[^A-Z]"),
        "is_path": (F.regexp_count(c, F.lit("/")) >= 2).cast("double"),
        "word_before": plain("before"), "word_after": plain("after"), "named_before": named,
        "assigned": lead.rlike("[=:]"), "quoted": own_lead.rlike("[\"'`]$"), "in_prose": prose}).drop("kinds")


def context_labels(found: DataFrame) -> DataFrame:
    """``label``: 1 for a quoted value assigned to a credential's name, 0 for a candidate
    in running prose without any of these signs, else null."""
    real = F.col("named_before") & F.col("assigned") & F.col("quoted")
    none = ~F.col("named_before") & ~F.col("assigned") & ~F.col("quoted") & F.col("in_prose")
    return found.withColumn("label", F.when(real, 1.0).when(none, 0.0))


def _fit(known: DataFrame, fit_rows: int) -> PipelineModel | None:
    """A forest on at most ``fit_rows`` rows, half of them of each kind, so that neither
    crowds the other out; None without rows of both."""
    half = [known.filter(F.col("label") == k).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(fit_rows // 2).select("label", *FEATURES)
            for k in (0.0, 1.0)]
    sample = common.materialize(half[0].union(half[1]), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    hashed = FeatureHasher(inputCols=WORDS, outputCol="__w", numFeatures=NEIGHBOURS)
    gather = VectorAssembler(inputCols=[*NUMBERS, "__w"], outputCol="__x")
    forest = RandomForestClassifier(featuresCol="__x", labelCol="label", probabilityCol="__p", rawPredictionCol="__r",
                                    predictionCol="__y", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Pipeline(stages=[hashed, gather, forest]).fit(sample.repartition(1).sortWithinPartitions("label", *FEATURES))


def _scored(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    if model is None:
        scored = found.withColumn("probability", F.lit(None).cast("double"))
    else:
        scored = model.transform(found).withColumn("probability", vector_to_array("__p")[1])
        scored = scored.drop("__w", "__x", "__p", "__r", "__y")
    return scored.withColumn("is_secret", F.coalesce(F.col("probability") >= 0.5, F.lit(False)))


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per candidate: id, word, candidate, features, signs, label, probability,
    is_secret."""
    found = common.materialize(context_labels(features(docs, id_col, text_col)), "secret-features")
    model = _fit((labelled if labelled is not None else found).filter("label IS NOT NULL"), fit_rows)
    return _scored(found.select("id", "word", "candidate", *FEATURES, *SIGNS, "label"), model).withColumnRenamed("id", id_col)


def held_out(found: DataFrame, fit_rows: int = FIT_ROWS) -> dict[str, float]:
    """Precision and recall of the forest on labelled findings of ``found`` (FEATURES and
    ``label``) that it wasn't trained on: half of the candidates, by their hash, so that
    equal ones are on one side."""
    known = found.filter("label IS NOT NULL").withColumn("side", F.pmod(F.xxhash64("candidate"), F.lit(2)))
    scored = _scored(known.filter("side = 1"), _fit(known.filter("side = 0"), fit_rows))
    r = scored.agg(*[F.count_if(w).alias(k) for k, w in (
        ("hit", F.col("is_secret") & (F.col("label") == 1)), ("said", F.col("is_secret")), ("real", F.col("label") == 1))]).first()
    return {"precision": r.hit / r.said if r.said else math.nan, "recall": r.hit / r.real if r.real else math.nan}
