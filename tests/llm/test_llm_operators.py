"""The training-data operators: brute force, invariants and odd inputs."""

import collections
import hashlib
import math
import os
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare_oracle import digest, duck  # noqa: E402
from logscan.llm import language_model as lm  # noqa: E402
from logscan.llm import line_dedup, mixing, ngram_join, queries, topk, toxicity  # noqa: E402
from logscan.llm.common import SPACE_WORDS, hashed_words, text_slices  # noqa: E402
from logscan.llm.decontamination import decontaminate, scan_documents  # noqa: E402
from logscan.llm.preferences import format_pairs, turn_lists  # noqa: E402
from logscan.llm.sharding import shard_by_bytes  # noqa: E402
from logscan.llm.warc import compare_replicas, record_hashes, warc_records  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, Size int, score string, id int"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
TEXTS = [None, "", "  \n\t ", "one", "Ünï cödé wörds and the rest of it", "a b c d e f g h i j k l", "a b c d e f g h i j k l", LONG]


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", None, 1, None, None)
            for i, t in enumerate(TEXTS)]
    rows += [(None, "a b c d e f g h i j k l", None, None, None, None, None, None), rows[5], rows[5], (3, "other text", "x", "s0", 0, 0, "", 0)]
    return spark.createDataFrame(rows, DOCS)


def none_of(spark):
    return spark.createDataFrame([], DOCS)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# ------------------------------------------------------------------- registered
def test_registered():
    names = E.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    df = E.queries()[name](spark, SF)
    rel = duck(SF).sql(queries.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


# --------------------------------------------------------------------- sharding
def test_shards_are_near_equal_and_gapless(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', repeat('x', int(id % 97))) as text")
    rows = shard_by_bytes(docs).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(rows) == 4000 and sorted(size) == list(range(16))
    assert max(size.values()) - min(size.values()) <= 2 * 98 + 0.002 * sum(size.values()) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(spark):
    out = shard_by_bytes(odd_docs(spark))
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 4 and out.columns.count("size") == 1
    assert sorted(r["size"] for r in rows)[0] == 1
    assert shard_by_bytes(none_of(spark)).count() == 0


# ----------------------------------------------------------------------- mixing
def test_targets_and_permutation():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([], []) == []
    for n in (1, 2, 5, 64, 1000):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 7))
        assert sorted(got) == list(range(n))
    counts = mixing.draw_counts([10, 0, 90], 8)
    assert counts.sum(axis=0).tolist() == [10, 0, 90] and counts.sum(axis=1).max() <= 13


def test_mix_equals_its_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = mixing.mix_counts(docs).toPandas().set_index("doc_id")
    texts = mixing.mixed_documents(docs).select("doc_id", "text").toPandas()
    assert texts.text.map(lambda t: len(words(t))).groupby(texts.doc_id).sum().to_dict() == {
        k: v for k, v in counts.taken.items() if v}
    assert (counts.taken <= 2 * counts["size"]).all()
    whole = docs.toPandas().set_index("doc_id").text
    assert counts["size"].to_dict() == {k: len(words(t)) for k, t in whole.items()}
    by = counts.assign(s=docs.toPandas().set_index("doc_id").source).groupby("s")
    assert ((by.taken.sum() - by.target.first()).abs() <= 0.5).all()


def test_mix_of_odd_rows(spark):
    rows = mixing.mix_counts(odd_docs(spark).drop("Size")).collect()
    assert len(rows) == len(TEXTS) + 4
    assert all(r.taken == 0 for r in rows if r["size"] == 0) and all(r.taken <= 2 * r["size"] for r in rows)
    assert mixing.mix_counts(none_of(spark).drop("Size")).count() == 0
    assert mixing.mixed_documents(odd_docs(spark)).where("text is null").count() == 0
    assert mixing.mixed_documents(none_of(spark)).count() == 0
    assert mixing.cut_words("a  b c\nd", [(0, 2), (3, 4)], 4) == "a  b\nd"


# -------------------------------------------------------------- decontamination
def brute_hits(texts, items, n=10):
    pat = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    grams = collections.defaultdict(set)
    for i, t in items:
        w = words(t, pat)
        k = min(n, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            grams[tuple(w[j:j + k])].add(i)
    out = []
    for t in texts:
        w, hit, found = words(t, pat), set(), set()
        for k in {len(g) for g in grams}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in grams:
                    hit.update(range(j, j + k))
                    found |= grams[tuple(w[j:j + k])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()))
    return out


def test_decontamination_against_brute_force(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, item), (2, "short one"), (3, None), (4, " .,"), (10, item), (5, "ÉTÉ")]
    texts = [item, "x " + item.upper() + " y", "a short-one b SHORT one", "alpha beta", None, "", item + " " + item,
             "short", "été", "ÉTÉ", "beta gamma delta epsilon zeta eta theta iota kappa lambda", LONG + " short one"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (32 << 20, 40):  # one broadcast, and several slices
        got = scan_documents(docs, bench, slice_bytes=size).orderBy("doc_id").collect()
        assert [(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got] == brute_hits(texts, items)
    kept = {r.doc_id for r in decontaminate(docs, bench).collect()}
    assert kept == {i for i, r in enumerate(brute_hits(texts, items)) if r[1] == 0}
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, "span").collect()}
    assert len(cut) == len(texts) and cut[1] == "x  y" and cut[3] == "alpha beta" and cut[4] is None
    assert scan_documents(docs.limit(0), bench).count() == 0
    assert scan_documents(docs, bench.limit(0)).where("contaminated").count() == 0


# --------------------------------------------------------------- language model
def test_every_id_is_scored_once():
    lens = [1, 15, 16, 17, 29, 30, 100]
    doc = np.repeat(np.arange(len(lens)), lens)
    slots = np.arange(len(doc)) + 1
    x, y, fresh, real, of = lm._cover(slots, doc, len(lens), lm.STRIDE, 0)
    assert sorted(y[fresh].tolist()) == slots.tolist()
    assert (x[fresh][(y[fresh] > 1)] <= y[fresh][(y[fresh] > 1)] - 0).all() and (x[:, 0] >= 0).all()


def test_model_is_causal_and_sums_to_one():
    p = lm.Attention.start(np.log(np.full(lm.SLOTS, 1 / lm.SLOTS)), seed=3)
    rng = np.random.default_rng(0)
    x = rng.integers(0, lm.SLOTS, (2, lm.CONTEXT))
    h, _ = lm._forward(p, x)
    total = np.exp(lm.target_log_probs(p, np.repeat(h[0, -1:], lm.SLOTS, axis=0), np.arange(lm.SLOTS))).sum()
    assert total == pytest.approx(1, abs=1e-4)
    later = x.copy()
    later[:, 9:] = rng.integers(0, lm.SLOTS, (2, lm.CONTEXT - 9))
    assert np.allclose(lm._forward(p, later)[0][:, :9], h[:, :9], atol=1e-5)


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in lm.Attention.start(np.log(np.full(lm.SLOTS, 1 / lm.SLOTS))).items()}
    x, y = rng.integers(0, 40, (2, 2, lm.CONTEXT))
    use = rng.random(x.shape) < 0.8
    _, g = lm.gradients(p, x, y, use)
    for name in p:
        at = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        ends = []
        for d in (1e-4, -1e-4):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += d
            ends.append(lm.gradients(q, x, y, use)[0])
        assert (ends[0] - ends[1]) / 2e-4 == pytest.approx(g[name][at], rel=2e-2, abs=1e-6), name


def test_base_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 50)  # most words take the way of the rare ones
    docs = odd_docs(spark).select("doc_id", "text")
    rows = lm.score_documents(docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    data = [(r.doc_id, r.text) for r in docs.collect()]
    counts = collections.Counter(w for i, t in data if not held(i) for w in [*words(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(words(t)) + 1, sum(1 for w in [*words(t), "\n"] if counts[w]), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), "\n"]), 4)) for i, t in data)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    assert got == want and all(r.score < 0 for r in rows)
    assert lm.score_documents(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ preferences
def test_common_prefix_and_masks(spark):
    schema = "conv_id long, turn long, role string, text string"
    t = spark.createDataFrame([(2, 0, "system", "S"), (2, 1, "user", "u"), (2, 2, "assistant", "good <|im_end|>"),
                               (None, 0, "assistant", "x"), (4, 0, None, "q"), (4, 1, "assistant", "same")], schema)
    other = spark.createDataFrame([(2, 0, "system", "S"), (2, 1, "user", "u"), (2, 2, "assistant", "bad"),
                                   (4, 0, "unknown", "q"), (4, 1, "assistant", "same")], schema)
    pairs = (turn_lists(t).withColumnRenamed("turns", "chosen")
             .join(turn_lists(other).withColumnRenamed("turns", "rejected"), "conv_id"))
    rows = {r.conv_id: r for r in format_pairs(pairs).collect()}
    assert sorted(rows) == [2, 4]
    r = rows[2]
    assert r.prompt == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nu<|im_end|>\n" and r.prompt_turns == 2
    assert r.chosen_completion == "<|im_start|>assistant\ngood < |im_end|><|im_end|>\n"
    s, = r.chosen_spans
    assert r.chosen_completion[s.start:s.end] == "good < |im_end|><|im_end|>"
    s, = r.rejected_spans
    assert r.rejected_completion[s.start:s.end] == "bad<|im_end|>"
    assert rows[4].identical and rows[4].chosen_completion == "" and rows[4].chosen_spans == []
    assert format_pairs(pairs.limit(0)).count() == 0
    assert turn_lists(t).count() == 2


# ------------------------------------------------------------------------ top-k
def test_topk_bound_prunes_by_columns():
    rng = np.random.default_rng(3)
    v = np.floor(64 * rng.normal(0, 1, (3000, 32)) * 0.8 ** np.arange(32))  # a falling spectrum
    ids, q, stats = np.arange(3000), np.arange(0, 3000, 20), {}
    number, score, vid = topk.search(v, ids, ids, v[q], q, np.full(len(q), -np.inf), stats=stats)
    full = v[q] @ v.T
    full[np.arange(len(q)), q] = -np.inf
    for k in range(len(q)):
        best = np.lexsort((ids, -full[k]))[:20]
        assert sorted(zip(-score[number == k], vid[number == k])) == [(-full[k][i], i) for i in best]
    steps = [stats[c] for c in sorted(stats)]
    assert len(steps) == 4 and steps == sorted(steps, reverse=True) and steps[-1] < steps[0] / 2


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(0, 1, (900, 8)).round(2)
    v[100:400] = v[100]  # ties
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (None, rows[0][1]), (2020, [1e15] * 8),
             (2040, [1.0, 2.0]), rows[20]]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, `row` int, Rank string")
    got = collections.Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_products(df).collect())
    ok = [(i, [math.floor(64 * x) for x in r]) for i, r in rows if i is not None and i not in (2000, 2001, 2002)]
    want = collections.Counter()
    for at, (q, x) in enumerate(ok):  # every row but the query's own is a candidate: row 20 is there twice
        if q % 20 == 0:
            s = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(x, c)))), i)
                       for n, (i, c) in enumerate(ok) if n != at and len(c) == len(x))[:20]
            want.update((q, k + 1, i, -y) for k, (y, i) in enumerate(s))
    assert got == want
    assert topk.top_products(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


# ------------------------------------------------------------------- line dedup
def brute_dedup(texts, window=25):
    """Lines of each text deleted by comparing all fingerprint windows directly."""
    data = [line_dedup.line_hashes(t) for t in texts]
    first, gone = {}, [set() for _ in texts]
    marks = [(key, d, a, n) for d, (h, w) in enumerate(data) for key, a, n in line_dedup.fingerprints(h, w, window)]
    for key, d, a, n in sorted(marks, key=lambda m: m[1:3]):
        if key not in first:
            first[key] = (d, a)
            continue
        e, b = first[key]
        lo, hi = line_dedup.extend(data[d][0], data[e][0], a, b, n)
        gone[d].update(range(lo, hi))
    return gone


def test_line_dedup_against_brute_force(spark):
    rng = np.random.default_rng(2)
    line = lambda: " ".join(f"v{x}" for x in rng.integers(0, 5000, rng.integers(1, 14)))
    runs = ["\n".join(line() for _ in range(12)) for _ in range(5)] + [" ".join(f"z{i}" for i in range(55))]
    texts = ["\n".join([line() for _ in range(rng.integers(0, 6))] + [runs[rng.integers(0, 6)]]
                       + [line() for _ in range(3)]) for _ in range(60)]
    texts += [None, "", "\n\n", runs[0] + "\n" + runs[0], LONG, LONG]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_lines string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    gone = brute_dedup(texts)
    for i, t in enumerate(texts):
        lines = t.split("\n") if t else []
        assert got[i].removed_lines == len(gone[i]) and got[i].n_lines == len(lines)
        if t:
            assert got[i].text == "\n".join(x for k, x in enumerate(lines) if k not in gone[i])
    for run in runs:  # every passage of 50 words stays once
        assert sum(run in (r.text or "") for r in got.values()) == (1 if any(run in (t or "") for t in texts) else 0)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    assert line_dedup.dedup_lines(odd_docs(spark)).count() == len(TEXTS) + 4


# ------------------------------------------------------------------ Jaccard join
def brute_components(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(texts)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_jaccard_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 70)  # keys are hot, groups take the tree
    rng = np.random.default_rng(9)
    base = [[f"t{x}" for x in rng.integers(0, 3000, n)] for n in (120, 120, 400)]
    texts = []
    for b in base:
        for _ in range(60):  # near copies around the threshold
            w = list(b)
            for k in rng.integers(0, len(w), rng.integers(0, max(2, len(w) // 40))):
                w[k] = f"e{rng.integers(0, 9999)}"
            texts.append(" ".join(w))
    texts += [" ".join(base[0][:60] + [f"u{x}" for x in rng.integers(0, 9999, 60)]) for _ in range(40)]
    texts += [None, "", " \n", "one two", "One  two", "a b c d e", "a b c d e f", LONG, LONG + " end", texts[0], texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n, comp = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: (n[i], comp[i]) for i in range(len(texts))}


def test_spanning_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(4)
    for nodes, edges in ((2, 1), (30, 20), (30, 400), (200, 300)):
        a = rng.integers(0, nodes - 1, edges)
        b = a + rng.integers(1, nodes - a)
        score = rng.integers(0, 5, edges) / 5.0  # many ties
        pick = ngram_join.spanning_forest(a, b, score)

        def trees(at):
            comp = list(range(nodes))
            find = lambda i: i if comp[i] == i else find(comp[i])
            for i in at:
                x, y = find(a[i]), find(b[i])
                comp[max(x, y)] = min(x, y)
            return [find(i) for i in range(nodes)]

        assert trees(pick) == trees(range(edges))
        assert len(pick) == nodes - len(set(trees(pick)))  # no pair too many


def test_any_heavy_table_keeps_the_prefix_rule():
    rng = np.random.default_rng(8)
    for _ in range(300):
        whole = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
        a = np.sort(rng.choice(whole, int(rng.integers(1, len(whole))), replace=False))
        gone = rng.random(len(a)) < 0.08
        b = np.unique(np.concatenate([a[~gone], rng.choice(whole, 2)]))
        heavy = np.sort(rng.choice(whole, int(rng.integers(0, len(whole))), replace=False))
        rank = rng.permutation(len(heavy))
        keys = [ngram_join.prefix_keys(x, heavy, rank) for x in (a, b)]
        assert [len(k) for k in keys] == [ngram_join.prefix_length(len(x)) for x in (a, b)]
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(*keys))


def test_heavy_shingles_are_the_shared_ones(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    texts = [f"{shared} " + " ".join(f"u{d}x{i}" for i in range(40)) for d in range(50)] + ["copied text of five words"] * 9
    heavy, rank = ngram_join.heavy_shingles(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    assert len(heavy) == 26 and sorted(rank) == list(range(1, 27)) and (np.diff(heavy.astype(np.float64)) > 0).all()
    none = ngram_join.heavy_shingles(spark.createDataFrame([(None,), ("",)], "text string"))
    assert len(none[0]) == len(none[1]) == 0


def test_jaccard_of_odd_rows(spark):
    rows = ngram_join.jaccard_components(odd_docs(spark)).collect()
    got = collections.Counter((r.doc_id, r.component_id) for r in rows)
    assert got[(5, 5)] == 3 and got[(6, 5)] == 1 and got[(None, 5)] == 1 and got[(0, 0)] == 1 and got[(3, 3)] == 2
    kept = ngram_join.keep_one_per_component(odd_docs(spark)).collect()
    assert collections.Counter(r.doc_id for r in kept) == {i: 1 for i in (0, 1, 2, 3, 4, 5, 7)}
    assert ngram_join.jaccard_components(none_of(spark)).count() == 0


# --------------------------------------------------------------------- toxicity
def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.QUERIES["op9_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    out = toxicity.score_documents(odd_docs(spark), labels)
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 4 and all(0 <= r.score <= 1 for r in rows) and out.columns.count("score") == 1
    alone = toxicity.score_documents(odd_docs(spark), labels.limit(0)).collect()
    assert len({r.score for r in alone}) == 1
    assert toxicity.score_documents(none_of(spark), labels).count() == 0


# ------------------------------------------------------------------------- WARC
def test_audit_finds_the_damage(spark):
    pages = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 50)) for i in range(2500)]
    pages += [(None, None, None), (None, "u", ""), (7, None, None), (40_000, "far", "x" * 300_000)]
    recs = warc_records(spark.createDataFrame(pages, "page_id long, url string, html string"))
    leaves = record_hashes(recs)
    assert compare_replicas(leaves, record_hashes(recs)).count() == 0
    other = leaves.selectExpr("file", "offset", "if(offset % 1999 = 3, 'bad', hash) as hash").where("offset % 1777 <> 5")
    other = other.unionByName(spark.createDataFrame([(99, 5, "new")], "file long, offset long, hash string"))
    a = {(r.file, r.offset): r.hash for r in leaves.collect()}
    b = {(r.file, r.offset): r.hash for r in other.collect()}
    want = {k: (a.get(k), b.get(k)) for k in {*a, *b} if a.get(k) != b.get(k)}
    got = compare_replicas(leaves, other).collect()
    assert {(r.file, r.offset): (r.hash_a, r.hash_b) for r in got} == want and len(got) == len(want)
    assert compare_replicas(leaves.limit(0), leaves.limit(0)).count() == 0


# --------------------------------------------------------------------- pipeline
def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    toxic = {r.doc_id for r in queries.QUERIES["op9_toxicity"](spark, SF).where("predicted = 1").collect()}
    left = docs[~docs.index.isin(toxic)]
    _, comp = brute_components(left.text.tolist())
    left = left[[i == c for i, c in enumerate(comp)]]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    hits = brute_hits(left.text.tolist(), list(zip(items.item_id, items.text)))
    left = left[[h[1] == 0 for h in hits]]
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(out.doc_id) <= set(left.index)
    n = left.text.map(lambda t: len(words(t)))
    taken = out.text.map(lambda t: len(words(t))).groupby(out.doc_id).sum()
    assert (taken <= 2 * n[taken.index]).all()
    sources = sorted(left.source.unique())
    sizes = [int(n[left.source == s].sum()) for s in sources]
    goal = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(sources))])
    got = taken.groupby(left.source[taken.index]).sum()
    assert [int(got.get(s, 0)) for s in sources] == [round(g) for g in goal]
    assert sorted(out.shard.unique()) == list(range(16))


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts = ["A bc", None, "", "bc a", "é\n bc", "x" * 70_000]
    seen = {}
    for first, data, offsets in text_slices(pa.array(texts), 8):
        w = hashed_words(data, offsets, SPACE_WORDS)
        for h, d, s, e in zip(w.hash.tolist(), w.doc.tolist(), w.start.tolist(), w.end.tolist()):
            seen.setdefault(w.data[s:e].tobytes(), set()).add(h)
    assert set(seen) == {x.encode() for t in texts for x in words(t)}
    assert all(len(h) == 1 for h in seen.values()) and len({min(h) for h in seen.values()}) == len(seen)
