"""Spelling variants, SentencePiece ids and periodic runs against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from bazaar.llm import periodic_runs, piece_encoding, queries, run_grammar, spelling_groups

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


# -- spelling variants -------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if v != w and one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (best if best is not None and counts[best] >= 2 * n else None, n, len(near))
    full = []
    for w, (form, n, n_near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        full.append((w, form, root, n, n_near, None if form is None else counts[form]))
    return by_row(full)


def brute_words(rows, slip=True):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def as_rows(frame):
    return by_row((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_variants_of_whole_table(docs, rows):
    counts = brute_words(rows)
    assert len(counts) > 300
    got = as_rows(spelling_groups.spelling_variants(docs, rewrite=spelling_groups.planted_slip))
    assert got == brute_groups(counts)
    assert any(r[4] for r in got)


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_groups_at_any_heat(spark, hot):
    rng = random.Random(hot)
    counts = {}
    for _ in range(60):                       # dense groups: many words share halves
        w = "".join(rng.choice("abé") for _ in range(rng.randint(2, 7)))
        counts[w] = rng.randint(3, 60)
        for _ in range(6):
            k = rng.randrange(len(w) + 1)
            v = rng.choice([w[:k] + "a" + w[k:], w[:k] + w[k + 1:], w[:k] + "b" + w[k + 1:]])
            if len(v) > 1:
                counts.setdefault(v, rng.randint(3, 60))
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_rows(spelling_groups.spelling_groups(frame, hot)) == brute_groups(counts)


def test_roots_of_a_long_chain(spark):
    words = {"a" * 4 + "b" * k: 3 * 2 ** k for k in range(1, 12)}
    got = as_rows(spelling_groups.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_groups(words)
    assert {r[2] for r in got} == {"a" * 4 + "b" * 11}


def test_counts_survive_a_small_dictionary(docs, rows, monkeypatch):
    monkeypatch.setattr(spelling_groups, "DICTIONARY", 50)
    got = {r.word: r.n for r in spelling_groups.word_counts(docs).collect()}
    assert got == brute_words(rows, slip=False)


def test_no_words(empty):
    assert spelling_groups.spelling_variants(empty).collect() == []


# -- SentencePiece -----------------------------------------------------------------

ODD = ["", " ", "  a", "a  b   ", "▁a▁▁b", "<s>hi</s>", "<0x0A>\n\t\x00x", "ｆｕ　é é", "日本 😀\U00020000", "x" * 3000,
       " " * 700, "<unk>", "ab" * 900 + " " + "ñ" * 77, "l'été\r\nfoo bar", "\U0010ffff ￿"]


def test_agenda_equals_library():
    enc = piece_encoding.PieceEncoder(piece_encoding.default_model())
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("  abehinorst▁éあ\n<0x>") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    want = [enc.library.encode(t) for t in texts]
    assert enc.encode(texts) == want
    for t, i in zip(texts, want):             # a heap for each whole text gives the same ids
        assert not t or enc.ids(enc.library.normalize(t)) == i


def test_memo_generations(monkeypatch):
    monkeypatch.setattr(piece_encoding, "MEMO_WORDS", 5)
    enc = piece_encoding.PieceEncoder(piece_encoding.default_model())
    for k in range(30):
        text = f"word{k % 9} thing{k % 4} word{k % 3} " + "long" * 40
        assert enc.encode([text])[0] == enc.library.encode(text)
        assert len(enc.fresh) < 5 + 5 and len(enc.old) < 10 and "▁" + "long" * 40 not in enc.old


def test_pieces_of_whole_table(docs, rows):
    from sentencepiece import SentencePieceProcessor
    lib = SentencePieceProcessor(model_file=piece_encoding.default_model())
    want = []
    for i, t in rows:
        ids = lib.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    got = piece_encoding.piece_digests(docs).collect()
    assert by_row((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == by_row(want)
    full = piece_encoding.encode_pieces(docs).filter("doc_id = 505").first()
    assert list(full.ids) == lib.encode(dict(rows)[505]) and full.decoded == lib.decode(list(full.ids))


@pytest.mark.parametrize("whole", [False, True])
def test_difference_to_library_raises(monkeypatch, whole):
    import pyarrow as pa
    enc = piece_encoding.PieceEncoder(piece_encoding.default_model())
    monkeypatch.setitem(piece_encoding._encoders, "x", enc)
    texts = ODD + [None, "over the hills"]
    batch = pa.RecordBatch.from_pydict({"i": list(range(len(texts))), "t": texts})
    assert sum(len(s[1]) for s in piece_encoding._steps(iter([batch]), "x", whole)) == len(texts)
    enc.fresh.clear()
    enc.pair_rank[:] = enc.pair_rank[::-1].copy()             # merges that are not the model's
    with pytest.raises(ValueError, match="differ"):
        list(piece_encoding._steps(iter([batch]), "x", whole))


def test_no_pieces(empty):
    assert piece_encoding.piece_digests(empty).collect() == []
    assert piece_encoding.encode_pieces(empty).collect() == []


# -- periodic runs -----------------------------------------------------------------

def brute_runs(w):
    """(start, length, period) by definition: maximal stretches of a period, of which
    those with a smaller period of their own are left out."""
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute_row(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def digest_rows(frame):
    return by_row((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
                  for r in frame.collect())


def test_runs_of_whole_table(docs, rows):
    got = digest_rows(periodic_runs.run_digests(docs, rewrite=periodic_runs.planted_tail))
    assert got == by_row(brute_row(i, t) for i, t in rows)
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_random_words():
    rng = random.Random(8)
    texts = []
    for _ in range(500):
        w = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(1, 9)
            part = [rng.choice("abc") for _ in range(k)]
            at = rng.randint(0, len(w))
            w[at:at] = part * rng.randint(2, 7) + part[:rng.randint(0, k)]
        texts.append([x.encode() for x in w])
    texts += [[b"a"] * 5, [b"a"] * 6, [b"a"] * 5000, [b"a", b"b"] * 3000, ([b"a"] * 7 + [b"b"]) * 40, []]
    got = periodic_runs.runs_of(texts)
    for w, runs in zip(texts, got):
        assert [(s, n, p) for s, p, n in runs] == sorted(brute_runs(w), key=lambda r: (r[0], r[2]))


def test_grammar_extensions():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 3, 300), np.tile(rng.integers(0, 5, 17), 30), np.repeat(rng.integers(0, 2, 40), rng.integers(1, 30, 40))]
    base, wall, _ = periodic_runs._walled(parts, 10)
    grammar = run_grammar.RunGrammar(base, wall)
    assert len(grammar.symbol) < 8 * len(base)
    a, b = rng.integers(1, len(base) - 1, (2, 3000))
    a, b = a[a != b], b[a != b]
    for back, sign in ((False, 1), (True, -1)):
        want = []
        for x, y in zip(a.tolist(), b.tolist()):
            k = 0
            while 0 <= x + sign * k < len(base) and 0 <= y + sign * k < len(base) and base[x + sign * k] == base[y + sign * k]:
                k += 1
            want.append(k)
        assert grammar.extend(a, b, back).tolist() == want


def test_run_rows_and_collapse(spark, empty):
    text = "so it goes on and on and on and on and on again ha ha ha ha ha ha end"
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(3, 9, 2), (13, 6, 1)]
    assert row.collapsed == "so it goes on and again ha end"
    assert periodic_runs.run_digests(empty).collect() == []


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_agenda_pieces", "op13_recompression_runs"])
def test_registered_columns(spark, name):
    first = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = {"op11_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
            "op12_agenda_pieces": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            "op13_recompression_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                        "collapsed_sha256"]}[name]
    assert first.columns == want and first.count() > 0
