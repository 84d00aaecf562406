"""The pipeline over a small table, each stage against its operator's brute force."""
import os
from collections import Counter

import numpy as np
import pyarrow as pa

import corpus_pipeline
from bazaar.llm import bounded_packing, common, grace_dedup, quality_forest, queries, raking
from tests.llm.test_dedup import brute_components, lowered
from tests.llm.test_text_operators import base_counts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.read_documents(spark, SF)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialize(stage(spark, docs, SF), name)
        if name != "pack":
            assert out.columns == docs.columns
        kept[name] = (docs, out)
        docs = out
    rows = {n: [(r.doc_id, r.text) for r in pair[0].select("doc_id", "text").collect()] for n, pair in kept.items()}
    left = {n: {r.doc_id for r in pair[1].select("doc_id").collect()} for n, pair in kept.items()}

    failed = {i for i, t in rows["quality"] if (c := base_counts(t))[0] < 50 or 100 * c[4] > 50 * c[0]}
    assert not failed & left["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {i for i, _ in rows["quality"] if labels.get(i) == 1} - failed
    assert len(good & left["quality"]) >= 0.98 * len(good)

    best = {}
    for i, t in rows["exact"]:
        best[lowered(t)] = max(best.get(lowered(t), -1), i)
    assert left["exact"] == set(best.values())

    assert left["near"] == set(brute_components(rows["near"]).values())
    assert left["mix"] <= left["near"] and len(left["mix"]) > 0.4 * len(left["near"])
    assert left["pack"] == left["mix"]
    total = Counter()
    for r in kept["pack"][1].collect():
        total[r.doc_id] += r.length
        assert 0 < r.length <= 1024
    assert all(total[r.doc_id] == r.doc_tokens for r in kept["pack"][1].collect())


def test_queries_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert os.path.exists(corpus_pipeline.__file__)


def test_workers_give_memory_back():
    """Freed memory doesn't stay with a Python worker that Spark keeps."""
    def anonymous():
        with open("/proc/self/status") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("RssAnon")) / 1024

    def work(batches):
        for batch in batches:
            arrow = [pa.array(np.full(2500, k)) for k in range(5000)]            # 100 MB each, in pieces below
            plain = [np.full(2500, k) for k in range(5000)]                      # what allocators map on their own
            pins = [np.full(100, k) for k in range(10)]
            del arrow, plain
            yield batch
            del pins

    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["a"])
    before = anonymous()
    assert [b.to_pydict() for b in common.lean(work)(iter([batch, batch]))] == [{"a": [1]}] * 2
    assert anonymous() - before < 40


def test_stages_run_lean(spark, docs, labels, monkeypatch):
    """Every function that a pipeline stage hands to Python workers is a lean one."""
    given, lean = [], common.lean
    monkeypatch.setattr(common, "lean", lambda run: given.append(lean(run)) or given[-1])
    plain = type(docs).mapInArrow

    def seen(self, run, *a, **b):
        assert any(run is x for x in given)
        return plain(self, run, *a, **b)

    monkeypatch.setattr(type(docs), "mapInArrow", seen)
    few = docs.filter("doc_id < 20")
    for stage in (lambda: quality_forest.keep_good(few, labels), lambda: grace_dedup.drop_duplicates(few),
                  lambda: raking.sample_mix(few), lambda: bounded_packing.pack(few)):
        assert stage().columns
    assert len(given) >= 6


def test_stages_bound_arrow_batches(spark, docs, labels, monkeypatch):
    """While a stage runs, no batch passes the bound by more than its last row; then the session's is back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own, seen = spark.conf.get(key), []
    monkeypatch.setattr(common, "BATCH_BYTES", 20_000)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"])

    plain = type(docs).mapInArrow

    def measured(self, run, *a, **b):
        seen.extend(plain(self, sizes, "rows long, size long").collect())
        return plain(self, run, *a, **b)

    monkeypatch.setattr(type(docs), "mapInArrow", measured)
    for name, stage in corpus_pipeline.STAGES:
        seen.clear()
        assert stage(spark, docs.filter("doc_id < 320"), SF).columns
        assert seen and all(r.rows == 1 or r["size"] <= 40_000 for r in seen), (name, max((r["size"], r.rows) for r in seen if r.rows > 1))
        assert spark.conf.get(key) == own
