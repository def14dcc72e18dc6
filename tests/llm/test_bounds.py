"""What reaches the driver, a worker's memory and a shuffle stays small."""

import collections
import os
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))

from logscan.llm import language_model as lm, ngram_join, toxicity  # noqa: E402
from logscan.llm.common import SPACE_WORDS, Scratch, hashed_words, released, text_slices  # noqa: E402


def words(rng, n, kinds=400):
    return " ".join(f"w{k}" for k in rng.integers(0, kinds, n))


# ------------------------------------------------------------------ any worker
def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_a_worker_gives_back_what_a_partition_needed():
    last = []

    def run(batches):
        held = [np.ones(8000) for _ in range(2000)]  # 128 MB in pieces of the heap
        last.append(np.ones(8000))  # lies above them, so the heap can't shrink
        yield len(held)

    before = resident()
    assert list(released(run)([])) == [2000]
    assert resident() < before + 40, (before, resident())


def test_words_are_cut_in_small_slices():
    rng = np.random.default_rng(3)
    texts = pa.array([words(rng, 1500) for _ in range(600)])  # some 4 MB
    hashed_words(*next(text_slices(texts))[1:], SPACE_WORDS)  # arrays that are kept for later calls
    tracemalloc.start()
    n = sum(len(hashed_words(data, offsets, SPACE_WORDS).hash) for _, data, offsets in text_slices(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 600 * 1500
    assert peak < 25e6, peak


def test_workers_of_the_mix_import_no_pandas():
    root = os.path.join(os.path.dirname(__file__), "..", "..")
    code = "import sys, logscan.llm.mixing; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


# --------------------------------------------------------------- language model
def test_one_model_reaches_the_driver(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    params = lm.Attention.start(np.full(lm.SLOTS, -np.log(lm.SLOTS)))
    w = rng.integers(0, lm.SLOTS, (30, lm.CONTEXT + 1)).astype(np.int16)
    rows = spark.createDataFrame([(x.tobytes(), i, i % 3) for i, x in enumerate(w)], "w binary, deal long, trainer long")
    seen, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    got = lm._averaged(rows, 3, params)
    size = sum(p.size for p in params.values())
    assert sum(len(r["p"]) for out in seen for r in out) == 8 * size
    models = [lm.train(params, w[k::3].astype(np.int64)) for k in range(3)]
    total = sum(np.concatenate([m[n].ravel() for n in sorted(m)]).astype(np.float64) * 10 for m in models)
    flat = np.concatenate([got[n].ravel() for n in sorted(got)])
    assert np.allclose(flat, total / 30, atol=1e-3)


def test_a_round_without_windows_keeps_the_model(spark):
    params = lm.Attention.start(np.full(lm.SLOTS, -np.log(lm.SLOTS)))
    none = spark.createDataFrame([], "w binary, deal long, trainer long")
    assert lm._averaged(none, 3, params) is params


# --------------------------------------------------------------------- toxicity
def test_a_counting_worker_is_small():
    rng = np.random.default_rng(6)
    texts = [words(rng, 1500) for _ in range(250)] + ["", None, "a"]  # some 1.7 MB
    y = [i % 2 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(y, type=pa.int32())], ["text", "y"])
    tracemalloc.start()
    rows = list(toxicity._count_partition([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6, peak
    got = {r["b"]: (r["toxic"], r["other"]) for b in rows for r in b.to_pylist()}
    want = collections.defaultdict(lambda: [0, 0])
    for first, data, offsets in text_slices(batch.column("text"), 1):  # one text at a time
        for key in toxicity.distinct_features(data, offsets).tolist():
            want[key & toxicity._MASK][1 - y[first + (key >> toxicity.BUCKETS_LOG2)]] += 1
    assert got == {b: tuple(n) for b, n in want.items()}


# ------------------------------------------------------------------ n-gram join
def test_common_shingles_are_counted_in_one_array(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [words(rng, 1200, kinds) for kinds in (6, 3000) for _ in range(400)]
    texts += [texts[0], None, "", "a b", words(rng, 9000)]
    monkeypatch.setattr(ngram_join, "HEAVY_PART", 1 << 19)
    list(ngram_join.shingle_sets(pa.array(texts)))  # arrays that are kept for later calls
    tracemalloc.start()
    got = list(ngram_join._repeated([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sets = [s for k, s in enumerate(ngram_join.shingle_sets(pa.array(texts))) if k != 800]
    want = collections.Counter(x for s in sets for x in s.tolist())
    got = {int(np.uint64(r["shingle"] & (2**64 - 1))): r["texts"] for b in got for r in b.to_pylist()}
    assert got == {x: n for x, n in want.items() if n >= ngram_join.HEAVY_MIN}
    assert peak < 25e6, peak


def test_texts_of_unlinked_documents_are_not_shuffled(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, words(rng, 60)) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " one more") for i in range(20)] + [(None, "alone"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, save = {}, Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: plans.__setitem__(
        name, df._jdf.queryExecution().executedPlan().toString()) or save(self, df, name))
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large table
    try:
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).where("doc_id <> 5").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert got == {i: (i - 1000 if i >= 1000 else i) for i, _ in rows if i is not None and i != 5}
    assert "Exchange" not in plans["sets-first"]
    assert "ArrowEvalPython" in plans["points"]


def test_the_filter_passes_every_id_and_few_others(spark):
    ids = [-(1 << 62), -1, 0, 63, 64, *range(1000, 3000, 2)]
    rows = spark.createDataFrame([(i,) for i in [*ids, *range(10_000, 15_000)]], "_id long")
    got = [r["_id"] for r in ngram_join._filtered(rows, spark.createDataFrame([(i,) for i in ids], "_id long")).collect()]
    assert set(ids) <= set(got) and len(got) < len(ids) + 50
    assert ngram_join._filtered(rows, rows.where(F.lit(False))).count() == 0
