"""Line dedup against plain comparison of whole texts, and on long texts."""

import time

import numpy as np
import pyarrow as pa

from logscan.llm import line_dedup


def common_runs(x, y, own):
    """(from, to in y, words): maximal runs of lines of ``y`` that stand in
    ``x`` too (further up, in the same text), found by comparing every line
    with every line."""
    for i in range(len(x)):
        for j in range(i + 1 if own else 0, len(y)):
            if x[i] == y[j] and (i == 0 or j == 0 or x[i - 1] != y[j - 1]):
                k = 0
                while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                    k += 1
                yield j, j + k, sum(len(w.split()) for w in y[j:j + k])


def test_runs_of_fifty_words_by_plain_comparison(spark):
    rng = np.random.default_rng(21)
    pool = [" ".join(f"q{k}_{i}" for i in range(rng.integers(0, 20))) for k in range(60)]
    shared = [list(rng.integers(0, 60, 9)) for _ in range(4)]
    texts = []
    for d in range(60):
        own = [f"d{d} line {i} of its own" for i in range(rng.integers(0, 8))]
        run = [pool[k] for k in shared[d % 4]][rng.integers(0, 4):]
        texts.append(own[:3] + run + own[3:] + (run if d % 10 == 0 else []))
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    for d, y in enumerate(texts):
        must, may = set(), set()
        for e in range(d + 1):
            for lo, hi, n in common_runs(texts[e], y, e == d):
                must |= set(range(lo, hi)) if n >= 50 else set()
                may |= set(range(lo, hi)) if n >= 25 else set()
        kept = got[d].text.split("\n") if got[d].removed_lines < len(y) else []
        assert len(y) - len(may) <= len(kept) <= len(y) - len(must)
        least = [x for i, x in enumerate(y) if i not in may]
        most = iter([x for i, x in enumerate(y) if i not in must])
        assert all(x in most for x in kept)  # nothing of a long run is left
        rest = iter(kept)
        assert all(x in rest for x in least)  # and no line without an earlier run is lost


def test_longest_agreement_by_plain_comparison():
    rng = np.random.default_rng(4)

    def agree(a, b, i, j):
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        return n

    for _ in range(60):
        a, b = (rng.integers(0, 3, rng.integers(1, 40)).astype(np.int64) for _ in range(2))
        at, places = (np.sort(rng.choice(len(x), rng.integers(1, len(x) + 1), replace=False)) for x in (a, b))
        got = line_dedup._Suffixes(a, b).longest(at, places)
        assert got.tolist() == [max(agree(a, b, i, j) for j in places) for i in at]
        got = line_dedup._Suffixes(a, a).longest_before(at)
        assert got.tolist() == [max([agree(a, a, i, j) for j in at[:k]], default=0) for k, i in enumerate(at)]


def runs_within(text):
    """Removed line spans of one text compared with itself."""
    h, w = line_dedup.line_hashes(text)
    rows = line_dedup._fingerprint_rows(25)(iter([pa.record_batch(
        {"id": [1], "th": [1], "lines": pa.array([h.view(np.int64)]), "words": pa.array([w])})]))
    hits = [{"lines": m["lines"], "first": m["lines"], "n": m["n"], "key": m["key"], "way": 0}
            for b in rows for m in b.to_pylist() if len(m["lines"]) > 1]
    one = pa.record_batch({"id": [1], "th": [1], "lines": pa.array([h.view(np.int64)]), "same": [True],
                           "first_lines": pa.array([h.view(np.int64)]),
                           "hits": pa.array([hits], type=pa.list_(pa.struct(
                               [("lines", pa.list_(pa.int32())), ("first", pa.list_(pa.int32())), ("n", pa.int32()),
                                ("key", pa.int64()), ("way", pa.int32())])))})
    out, = line_dedup._runs(iter([one]))
    return out.column("runs").to_pylist()[0]


def test_long_texts_take_time_in_proportion():
    line = " ".join(f"w{i}" for i in range(25))
    start = time.time()
    h, w = line_dedup.line_hashes("\n" * (1 << 20) + line + "\n" * 1000 + line)
    assert len(line_dedup.fingerprints(h, w)) == 2  # one line of 25 words, at two places
    assert time.time() - start < 8  # quadratic work takes many minutes
    start = time.time()
    spans = runs_within("\n".join([line] * 30_000))
    assert min(s["b"] for s in spans) == 1 and max(s["e"] for s in spans) == 30_000
    assert time.time() - start < 20
