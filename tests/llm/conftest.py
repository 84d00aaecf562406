import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, row long, kept boolean, a string"


def prose(rng, n, vocabulary=400):
    words = ["".join(rng.choice("abcdefgilmnoprstué") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    out = []
    while len(out) < n:
        k = min(rng.randint(2, 14), n - len(out))
        out.append(" ".join(rng.choice(words) for _ in range(k)).capitalize() + rng.choice([".", ".", "!", ".\n"]))
        n -= 0
        if sum(len(x.split()) for x in out) >= n:
            break
    return " ".join(out)


def cases():
    """(doc_id, text) rows: prose, copies, near copies, passages that repeat, nulls,
    empty and blank texts, ties, repeated rows, odd characters, one long text."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i, prose(rng, rng.choice([3, 6, 12, 40, 120, 300]))))
    for i in range(12):                      # exact copies, also in other letter case
        rows.append((100 + i, rows[i * 3][1] if i % 2 else rows[i * 3][1].upper()))
    for i in range(25):                      # near copies by changed words
        words = rows[i][1].split(" ")
        for _ in range(rng.randint(1, 1 + len(words) // 15)):
            words[rng.randrange(len(words))] = "zz" + str(rng.randrange(99))
        rows.append((200 + i, " ".join(words)))
    passage = prose(rng, 80)
    for i in range(20):
        rows.append((300 + i, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 25)))
    for n in range(1, 14):                   # tiny sets, each with a neighbour
        w = [f"w{k}" for k in range(n + 4)]
        rows += [(400 + 2 * n, " ".join(w)), (401 + 2 * n, " ".join(w[:-1] + ["other"]))]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (503, "one"), (504, "one"), (None, "one"), (None, None),
             (None, rows[2][1]), (505, "a b c d\x1ce 'tis it's 12,5 ½ 漢字 漢　字 😀  two\n\nthree \t end "),
             (506, "Licensed under the Apache Licence, Version 2.0. CC BY; the MIT License! Mozila Public License"),
             (507, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and a very plaincompoundwordofletters.'),
             (508, "na " * 70), (509, "nul\x00byte " * 60), (510, "Ünï çødé " * 40)]
    rows.append((511, prose(rng, 30_000)))
    rows.append((512, "x" * 5000))
    return rows


@pytest.fixture(scope="session")
def rows():
    return cases()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    full = [(i, t, None if k % 17 == 0 else "en" if k % 3 else "fr", None if k % 19 == 0 else f"src{k % 4}",
             len(t or ""), 7, 8, False, "x") for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(full, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


@pytest.fixture(scope="session")
def labels(spark, rows):
    ids = sorted({i for i, _ in rows if i is not None})
    return spark.createDataFrame([(i, 0 if i in (508, 509, 512) else 1, 0) for i in ids] + [(None, 1, 0), (3, None, None)],
                                 "doc_id long, quality int, toxic int")
