"""De-duplication operators against brute force on the shared edge cases."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bazaar.llm import grace_dedup, partenum_join, sentence_spans, suffix_dedup, words
from bazaar.llm.components import connected_components
from bazaar.llm.run_length_index import RunLengthIndex


def key(row):
    return tuple((v is not None, v) for v in row)


# -- exact ------------------------------------------------------------------------

def lowered(text):
    return (text or "").encode().lower()


def test_exact_groups(docs, rows):
    want, groups = [], defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(t).hexdigest()) for i in ids]
    for limit in (grace_dedup.BUCKET_BYTES, 2000):       # the small one recurses
        got = grace_dedup.duplicate_groups(docs, bucket_bytes=limit).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_drop_keeps_columns_and_empty(docs, rows, empty):
    left = grace_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert left.count() == len({lowered(t) for _, t in rows})
    assert grace_dedup.duplicate_groups(empty).count() == 0


def test_content_table_compares_contents():
    table = grace_dedup.ContentTable()
    assert [table.place(7, b"%d" % (i % 900)) for i in range(1800)] == \
        [(i % 900, i < 900) for i in range(1800)]        # one hash for all: only contents differ


# -- near duplicates ----------------------------------------------------------------

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and 100 * len(a & b) >= 75 * len(a | b):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in parent}


def test_near_components(docs, rows):
    comp = brute_components(rows)
    want = [(i, len(shingles(t)), comp.get(i)) for i, t in rows]
    got = [tuple(r) for r in partenum_join.jaccard_components(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len(set(comp.values())) < len(comp) - 20


def test_near_drop_and_empty(docs, empty):
    assert partenum_join.jaccard_components(empty).count() == 0
    left = partenum_join.drop_linked(docs.filter("doc_id < 120"))
    assert left.columns == docs.columns
    assert left.count() == len({r.component_id for r in partenum_join.jaccard_components(docs.filter("doc_id < 120")).collect()})


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for _ in range(1500):
        n = int(rng.integers(1, 40) if rng.random() < 0.6 else rng.integers(40, 2500))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = np.delete(a, rng.integers(0, len(a), int(rng.integers(0, len(a) // 4 + 1))))
        b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, len(a) // 4 + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(b) and partenum_join.linked(common, len(a), len(b)):
            assert len(np.intersect1d(partenum_join.signatures(a), partenum_join.signatures(b))), (len(a), len(b), common)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200, 260)] + [(9, k) for k in range(10, 60)] + [(5, 5), (300, 301), (301, 300)]
    rng.shuffle(links)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 200 for i in range(200, 261)} | {9: 9} | {k: 9 for k in range(10, 60)} | {300: 300, 301: 300}


# -- sentence spans ------------------------------------------------------------------

def split(text):
    """Sentences as (words, stripped text, range of characters)."""
    space = r"[\x20\x09-\x0d]"
    out, start, last = [], 0, None
    for m in re.finditer(r"[^\x20\x09-\x0d]+", text):
        if last is not None and (last.group()[-1] in ".!?" or "\n" in text[last.end():m.start()]):
            out.append((start, m.start()))
            start = m.start()
        last = m
    if last is not None:
        out.append((start, len(text)))
    return [(len(re.findall(r"[^\x20\x09-\x0d]+", text[a:b])), re.sub(f"^{space}+|{space}+$", "", text[a:b]), a, b) for a, b in out]


def brute_spans(rows):
    texts = [split(t or "") for _, t in rows]
    occurrences = defaultdict(list)
    for k, s in enumerate(texts):
        order = (rows[k][0] is None, rows[k][0] or 0)
        for i in range(len(s)):
            for n in (1, 2, 3):
                if i + n <= len(s):
                    count = sum(x[0] for x in s[i:i + n])
                    if count >= 25 or (n == 3 and count >= 10):
                        occurrences[tuple(x[1] for x in s[i:i + n])].append((order, k, i, n))
    return texts, occurrences


def test_sentence_spans(docs, rows):
    got = sentence_spans.remove_repeated_spans(docs).collect()
    texts, occurrences = brute_spans(rows)
    gone = defaultdict(set)
    for found in occurrences.values():
        for _, k, i, n in sorted(found)[1:]:
            gone[k] |= set(range(i, i + n))
    # rows that share an id are ordered by row, which brute force doesn't know
    tied = {i for i, c in Counter(i for i, _ in rows).items() if c > 1}
    want = sorted((i, len(texts[k]), len(gone[k]),
                   "".join(t[s[2]:s[3]] for n, s in enumerate(texts[k]) if n not in gone[k]) if gone[k] else t or "")
                  for k, (i, t) in enumerate(rows) if i not in tied)
    assert sorted((r.doc_id, r.n_sentences, r.n_removed, r.kept_text) for r in got if r.doc_id not in tied) == want
    assert len(got) == len(rows) and sum(bool(g) for g in gone.values()) > 30
    assert all(sum(s.n for s in r.removed_spans) == r.n_removed for r in got)


def test_sentence_spans_in_small_chunks_and_empty(docs, empty, monkeypatch):
    want = sorted((r.doc_id or -1, r.n_removed) for r in sentence_spans.remove_repeated_spans(docs).collect())
    monkeypatch.setattr(sentence_spans, "CHUNK_RUNS", 50)
    assert sorted((r.doc_id or -1, r.n_removed) for r in sentence_spans.remove_repeated_spans(docs).collect()) == want
    assert sentence_spans.remove_repeated_spans(empty).count() == 0


def test_short_sentences_grow_into_runs(spark):
    rng = random.Random(8)

    def one_word(n):
        return " ".join("".join(rng.choice("ABCDEFGH") for _ in range(9)) + "!!" for _ in range(n))

    passage, whole, tail = one_word(60), one_word(12), "one two three four five six seven eight nine ten. Yes. No. So. Oh. Ah."
    texts = [passage, one_word(30) + " " + passage + " " + one_word(30), whole, whole, one_word(9), "a b c d\ne f\ng\nh\ni j", tail, tail]
    texts += [texts[4], texts[5]]
    got = {r.doc_id: r for r in sentence_spans.remove_repeated_spans(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[1].kept_text == texts[1].replace(passage + " ", "")
    assert [tuple(s) for s in got[1].removed_spans] == [(30, 60)]
    assert [got[k].kept_text for k in (3, 7, 9)] == ["", "", ""]
    assert all(got[k].kept_text == texts[k] for k in (0, 2, 4, 5, 6, 8))     # nine words are below the minimum


# -- suffixes --------------------------------------------------------------------------

def test_matching_statistics():
    rng = random.Random(2)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).encode() for _ in range(12)]
    strings += [strings[3][:20] + strings[4], b"\0\0ab\0", "né né né".encode()]
    index = RunLengthIndex(strings)
    assert index.run_lengths.sum() == index.n
    got = index.matching_statistics()
    for s, begin in zip(strings, index.starts):
        for i in range(len(s)):
            best = 0
            for t, other in zip(strings, index.starts):
                for j in range(len(t)):
                    if (other, j) != (begin, i):
                        n = 0
                        while i + n < len(s) and j + n < len(t) and s[i + n] == t[j + n]:
                            n += 1
                        best = max(best, n)
            assert got[begin + i] == best, (s, i)


def brute_removed(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        mark = np.zeros(len(b) + 1, np.int8)
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                mark[p:p + length] = 1
        mark[len(b)] = 0
        kept = bytes(np.frombuffer(b, np.uint8)[mark[:-1] == 0])
        out.append((i, len(b), int(mark.sum()), int((np.diff(np.r_[0, mark]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_removal(docs, rows):
    for length, options in ((suffix_dedup.LENGTH, {}),
                            (40, {"probe": 24, "key": 8, "bucket_bytes": 3000}),
                            (40, {"probe": 24, "key": 8, "hot_segments": 5})):
        want = brute_removed(rows, length)
        got = suffix_dedup.removed_spans(docs, length=length, **options).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=key) == sorted(want, key=key)
        assert all(sum(s.end - s.begin for s in r.removed) == r.n_removed for r in got)
        assert sum(w[2] > 0 for w in want) > 20


@pytest.mark.parametrize("length", [600, 1500])
def test_long_repeats(spark, length):
    """Stretches far longer than the window, alone and within texts."""
    rng = np.random.default_rng(length)
    draw = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = [draw(3000), draw(length), draw(length - 1)]
    rows = [(k, draw(300) + shared[k % 3] + draw(200)) for k in range(9)] + [(20, shared[0]), (21, shared[0][:length + 7]), (22, None)]
    got = suffix_dedup.removed_spans(spark.createDataFrame(rows, "doc_id long, text string"), length=length).collect()
    want = brute_removed(rows, length)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert sum(r.n_removed for r in got) > 5 * 3000 and all(r.has_repeats == (r.n_removed > 0) for r in got)


def test_suffix_removal_in_small_chunks_and_empty(docs, rows, empty, monkeypatch):
    assert suffix_dedup.removed_spans(empty).count() == 0
    data = np.frombuffer(rows[-2][1].encode(), np.uint8)
    whole = [suffix_dedup.anchors(data, 24, 40)[0]]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    parts = [suffix_dedup.anchors(data[a:b], 24, 40)[0] + a for a, b in suffix_dedup._chunks(len(data), 40)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(parts))


def test_two_hashes_are_independent():
    data = np.random.default_rng(0).integers(97, 123, 4000).astype(np.uint8)
    at = np.arange(3900)
    one, two = words.span_hashes(data, at, at + 40), words.span_hashes(data, at, at + 40, words.OTHER_BASE)
    assert len(np.unique(one)) == len(np.unique(two)) and not np.any(one == two)
    data[2000:2040] = data[100:140]
    again = words.span_hashes(data, at, at + 40, words.OTHER_BASE)
    assert again[2000] == again[100]


def test_known_runs_are_dealt_by_row(spark):
    """A run that all texts hold: what one task finds again is spread over the parts."""
    import pyarrow as pa
    from bazaar.llm import deal, sentence_spans
    text = "One sentence with more than enough words to be a run of its own here. Another of them with ten words or more. And a third one."
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(range(1000)), pa.array([text] * 1000)], names=["row", "id", "text"])
    dealt = list(sentence_spans._deal_runs(8)(iter([batch])))
    known = [int(np.frombuffer(b, np.uint8).sum()) for x in dealt for b in x.column("known").to_pylist()]
    assert sum(known) > 900 and max(known) < 0.25 * sum(known)


def test_long_texts_hash_like_short_ones(monkeypatch):
    data = np.frombuffer(("Some wörds " * 3000).encode(), np.uint8)
    offsets = np.array([0, len(data)])
    whole = words.word_hashes(data, offsets)[0]
    monkeypatch.setattr(words, "_SEGMENT", 500)
    assert np.array_equal(whole, words.word_hashes(data, offsets)[0])


def test_sketches_of_a_group_come_once():
    """A member's sketch is sent once per group, ahead of the buckets that name it."""
    sets = [np.arange(40, dtype=np.uint64) * np.uint64(977) + np.uint64(shift) for shift in (0, 0, 5)]
    sketches = [partenum_join.parity_sketch(s) for s in sets]
    rows = [(7, None, i, i, 40, x) for i, x in enumerate(sketches)]
    rows += [(7, b, i, None, None, None) for b in (1, 2, 3) for i in range(3)]
    rows += [(8, None, 0, 0, 40, sketches[0]), (8, None, 1, 0, 40, sketches[1])]          # one component: no pair
    rows += [(8, 4, i, None, None, None) for i in range(2)]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], kind) for k, kind in enumerate(kinds)],
                                          names=["grp", "bucket", "rep", "comp", "n", "sketch"])
               for part in (rows[:5], rows[5:])]
    found = [tuple(r.values()) for batch in partenum_join._across(iter(batches)) for r in batch.to_pylist()]
    assert found == [(0, 1)]


def crowd(count, swapped):
    """Sets of 100 that each differ from one set by a few elements of their own."""
    rng = np.random.default_rng(count)
    base = rng.integers(1, 1 << 63, 100).astype(np.uint64)
    sets = []
    for k in range(count):
        n = swapped[k % len(swapped)]
        own = rng.integers(1, 1 << 63, n).astype(np.uint64)
        sets.append(np.unique(np.r_[np.delete(base, rng.choice(100, n, replace=False)), own]))
    return sets


def test_a_crowd_gives_no_row_per_pair():
    """Members of one large bucket, all in components of their own, whose pairs nearly all pass the bound."""
    sets = crowd(200, [7])
    rows = [(7, None, i, i, len(x), partenum_join.parity_sketch(x)) for i, x in enumerate(sets, 1)]
    rows += [(7, b, i, None, None, None) for b in (1, 2) for i in range(1, 201)]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                       names=["grp", "bucket", "rep", "comp", "n", "sketch"])
    found = [tuple(r.values()) for b in partenum_join._across(iter([batch])) for r in b.to_pylist()]
    assert found == [(1, i) for i in range(2, 201)]


@pytest.mark.parametrize("swapped", [[7], [8], [9], [2, 8, 9, 10, 11]])
def test_neighbourhood_joins_components(swapped):
    """Fewer links than members, the same components as by all links; given components count."""
    sets = crowd(120, swapped) + crowd(30, [8])[:10] + [np.arange(1, 140, dtype=np.uint64), np.arange(1, 181, dtype=np.uint64)]
    comp = [k // 3 if k < 30 else k for k in range(len(sets))]

    def merged(links):
        label = list(comp)
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    every = [(a, b) for b in range(len(sets)) for a in range(b)
             if partenum_join.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
    got = partenum_join._joining(list(range(len(sets))), comp, sets)
    assert {(min(p), max(p)) for p in got} <= set(every)
    assert merged(got) == merged(every)
    assert len(got) == len(set(comp)) - len(set(merged(every)))


def test_neighbourhoods_of_texts(spark, monkeypatch):
    """Texts around one, in an order that leaves the smallest of them linked with few."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(104)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.sample(range(20), 3 if i else 9):
            w[5 * k + rng.randrange(5)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    stored, counts = partenum_join._stored, {}

    def counted(df, name):
        out = stored(df, name)
        counts[name] = max(counts.get(name, 0), out.count())
        return out

    monkeypatch.setattr(partenum_join, "_stored", counted)
    got = {r.doc_id: r.component_id for r in partenum_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_components(rows)
    assert 0 < counts["neighbourhoods"] < 300 and counts["to-verify"] < 300
