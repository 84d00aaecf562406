"""License scans: fuzzy search of short notices.

Texts become words (ASCII letters and digits, lower-cased, and everything beyond
ASCII) joined by single blanks.  Base phrases are found as consecutive words.
For fuzzy matches up to ``e`` edits are allowed; a notice is split into ``e + 1``
seeds, of which one must occur unchanged (pigeonhole).  Around every seed the
``regex`` library verifies the notice with a bounded number of edits and reports
the span.  Notices too short for an edit are matched exactly.

Defined cases: null text is empty text (no words); a document without a match
has empty label strings, null positions and score 0; ids may be null or
repeated; further columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further names that the fuzzy search knows.
NAMES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "spdx license identifier": "spdx",
}
#: Sentences of the licences' own short notices.
GRANTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "licensed under the apache license version 2 0": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license": "gpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
    "and accompanying documentation covered by this license": "bsl",
    "this work is licensed under a creative commons attribution": "cc-by",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document": "wtfpl",
}
NOTICES = BASE_PHRASES | NAMES | GRANTS
LETTERS_PER_EDIT = 9     # a notice of n characters may differ by n // 9 edits,
MAX_EDITS = 4            # and by no more than these
SAFE_LENGTH = 14         # shorter names may not differ

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SPANS = "array<struct<label:string,word:bigint,n_words:bigint,edits:int,text:string>>"
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()),
                            ("edits", pa.int32()), ("text", pa.string())]))


def normalise(text: bytes) -> tuple[bytes, int]:
    """(blank-separated words with a blank at both ends, number of words)."""
    found = text.translate(_PLAIN).split()
    return b" " + b" ".join(found) + b" ", len(found)


class Notice:
    """One phrase with its seeds and its verifying pattern."""

    def __init__(self, phrase: str, label: str, letters_per_edit: int = LETTERS_PER_EDIT):
        self.phrase, self.label = phrase.encode(), label
        self.edits = min(len(self.phrase) // letters_per_edit, MAX_EDITS) if len(self.phrase) >= SAFE_LENGTH else 0
        n = self.edits + 1
        cut = [k * len(self.phrase) // n for k in range(n + 1)]
        self.seeds = [(cut[k], self.phrase[cut[k]:cut[k + 1]]) for k in range(n)]
        # best match first; a match starts and ends at words
        self.pattern = regex.compile(rb"(?b)(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(self.phrase), self.edits))

    def _exact(self, text: bytes) -> list[tuple[int, int, int]]:
        key, out = b" " + self.phrase + b" ", []
        at = text.find(key)
        while at >= 0:
            out.append((at + 1, at + len(key) - 1, 0))
            at = text.find(key, at + len(key) - 1)
        return out

    def _windows(self, text: bytes, exact: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        """Stretches around seeds outside exact matches, one for the seeds of one place."""
        width, begins = len(self.phrase) + self.edits + 1, [e[0] for e in exact]
        windows = []
        for offset, seed in self.seeds:
            at = text.find(seed)
            while at >= 0:
                k = bisect.bisect_right(begins, at) - 1
                if k < 0 or at + len(seed) > exact[k][1]:
                    windows.append((max(0, at - offset - self.edits - 1), at - offset + width))
                at = text.find(seed, at + 1)
        joined: list[tuple[int, int]] = []
        for low, high in sorted(windows):
            # seeds of one place lie apart by the edits at most, so windows don't grow on and on
            if joined and low - first <= 2 * self.edits:
                joined[-1] = joined[-1][0], max(high, joined[-1][1])
            else:
                first = low
                joined.append((low, high))
        return joined

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) of matches, at most one per overlapping stretch."""
        exact = self._exact(text)
        if not self.edits:
            return exact
        found: list[tuple[int, int, int]] = []
        spans = exact + [(m.start(), m.end(), sum(m.fuzzy_counts)) for low, high in self._windows(text, exact)
                         for m in self.pattern.finditer(text, low, min(high, len(text)))]
        for span in sorted(spans):
            if found and span[0] < found[-1][1]:
                if span[2] < found[-1][2]:
                    found[-1] = span
            else:
                found.append(span)
        return found


def scan(text: bytes, notices: list[Notice], base: dict[bytes, str]) -> dict:
    plain, n_words = normalise(text)
    places, base_labels = [], set()
    for phrase, label in base.items():
        key = b" " + phrase + b" "
        at = plain.find(key)
        while at >= 0:
            places.append(at)
            base_labels.add(label)
            at = plain.find(key, at + 1)
    hits = [(notice, *hit) for notice in notices for hit in notice.find(plain)]
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32) if places or hits else None
    places = np.searchsorted(blanks, places).tolist() if places else []
    spans, score = [], 1.0 if places else 0.0
    words = np.searchsorted(blanks, [h[1] for h in hits]).tolist() if hits else []
    for (notice, start, end, edits), word in zip(hits, words):
        text_found = plain[start:end]
        spans.append({"label": notice.label, "word": word - 1, "n_words": text_found.count(b" ") + 1, "edits": edits,
                      "text": text_found.decode(errors="replace")})
        score = max(score, 1.0 - edits / len(notice.phrase))
    spans.sort(key=lambda s: (s["word"], s["label"]))
    return {"n_words": n_words, "n_base": len(places), "first_word": min(places, default=None),
            "last_word": max(places, default=None), "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | {s["label"] for s in spans})), "score": score, "spans": spans}


_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
           ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPAN)]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 notices: dict[str, str] = NOTICES, base: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """One row per input row: word counts, base places and labels, all labels, the
    best score, and the spans (label, first word, words, edits, text) found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Notice(p, label) for p, label in notices.items()]
        exact = {p.encode(): label for p, label in base.items()}
        for batch in batches:
            text = pc.fill_null(batch.column(1).cast(pa.large_string()), "").cast(pa.large_binary())
            step = 1000
            for at in range(0, batch.num_rows, step):
                found = [scan(t.as_py(), known, exact) for t in text.slice(at, step)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, step)] + [pa.array([f[k] for f in found], kind) for k, kind in _FIELDS],
                    names=["id"] + [k for k, _ in _FIELDS])

    base_cols = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              f"labels string, score double, spans {SPANS}")
    return base_cols.mapInArrow(run, schema).withColumnRenamed("id", id_col)
