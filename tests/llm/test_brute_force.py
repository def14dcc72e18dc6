"""Whole results of operators that SQL cannot state, against plain versions
written without the operators' own helpers."""

import collections
import hashlib
import math
import os
import re
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from logscan.llm import language_model as lm  # noqa: E402
from logscan.llm import mixing, toxicity  # noqa: E402
from logscan.llm.sharding import shard_by_bytes  # noqa: E402
from logscan.llm.warc import OP10_SQL, compare_replicas, damaged, record_index, warc_records  # noqa: E402

MID = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ language model
def test_held_out_texts_are_scored_above_their_counts(spark):
    rows = lm.op4_lm_scoring(spark, MID).where("held_out").collect()
    assert len(rows) > 100
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_every_id_has_a_slot_and_shares_sum_to_one():
    rank = np.random.default_rng(2).permutation(lm.N_IDS)
    slot = lm.slots_by_rank(rank)
    own = lm.SLOTS - lm.TAIL_SLOTS
    assert slot[rank[:own]].tolist() == list(range(own))
    held = np.bincount(slot, minlength=lm.SLOTS)
    assert (held[:own] == 1).all() and held[own:].min() >= held[own:].max() - 1 > 0
    assert sorted(lm.slots_by_rank(np.arange(10))) == list(range(10))


# ------------------------------------------------------------------------ toxicity
def grams(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    t = " " + re.sub("[\t-\r]", " ", t) + " "
    return {t[i:i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1)}


def plain_scores(docs, labels):
    """Scores of texts by a dense logistic regression over n-gram presence
    times log-count ratio, of every n-gram that enough labelled texts hold."""
    y = {}
    for i, t in labels:
        if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            y[i] = max(y.get(i, 0), t)
    fit = [(grams(t), y[i]) for i, t in docs if i in y]
    pos = sum(1 for _, v in fit if v == 1)
    neg = len(fit) - pos
    toxic, other = collections.Counter(), collections.Counter()
    for g, v in fit:
        (toxic if v == 1 else other).update(g)
    names = sorted(g for g in {*toxic, *other} if 3 <= toxic[g] + other[g] < len(fit))
    at = {g: k for k, g in enumerate(names)}
    ratio = np.array([math.log((toxic[g] + 1) / (pos + 2)) - math.log((other[g] + 1) / (neg + 2)) for g in names])

    def matrix(sets):
        x = np.zeros((len(sets), len(names) + 1))
        x[:, -1] = 1
        for r, s in enumerate(sets):
            hit = [at[g] for g in s if g in at]
            x[r, hit] = ratio[hit]
        return x

    x, t = matrix([g for g, _ in fit]), np.array([float(v == 1) for _, v in fit])
    w, m, v = np.zeros(x.shape[1]), 0, 0
    w[-1] = math.log((pos + 1) / (len(fit) + 2) / (1 - (pos + 1) / (len(fit) + 2)))
    decay = np.append(np.full(len(names), 1e-4), 0)
    for step in range(1, 201):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - t) / len(t) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return len(names), 1 / (1 + np.exp(-matrix([grams(t) for _, t in docs]) @ w))


def test_toxicity_against_a_plain_classifier(spark):
    good, bad = "the quiet river runs along green Fields".split(), "you stupid vile Rotten fool go away".split()
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(bad if i % 3 == 0 else good, 6)) + ["", "\tÜnï", "\n"][i % 3 - 1]) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "vile river"), (63, docs[5][1])]
    labels = [(i, int(i % 3 == 0)) for i in range(50)] + [(3, 0), (None, 1), (52, None)]
    n, want = plain_scores(docs, labels)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert n < toxicity.MAX_FEATURES  # every n-gram is a feature of both versions
    got = {r.doc_id: r.score for r in toxicity.score_documents(frame, table).collect()}
    assert np.allclose([got[i] for i, _ in docs], want, atol=1e-6)
    assert got[62] != got[60] == got[61]


# ------------------------------------------------------------------------ sharding
def test_shards_are_cuts_of_one_order(spark):
    """Shards by a given key against a plain sort: each holds a run of the
    sorted rows, and its bytes end within one key of an equal share."""
    rng = np.random.default_rng(6)
    rows = [(i, "x" * int(rng.integers(0, 200)), int(rng.integers(0, 1 << 62))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place long")
    out = {r.doc_id: r.shard for r in shard_by_bytes(docs, n_shards=7, key=docs["place"]).collect()}
    order = sorted(rows, key=lambda r: r[2])
    shards = [out[r[0]] for r in order]
    assert shards == sorted(shards) and len(out) == len(rows)
    ends = np.cumsum([len(r[1]) + 1 for r in order])
    share, most = ends[-1] / 7, 201
    for s in range(1, 7):
        assert abs(ends[shards.index(s) - 1] - s * share) <= max(most, 0.0005 * share)


# -------------------------------------------------------------------------- mixing
def test_mix_of_columns_with_clashing_names(spark):
    plain = spark.createDataFrame([(i, f"w{i} " * (i % 7), f"s{i % 3}") for i in range(40)] + [(None, None, None)] * 2,
                                  "doc_id long, text string, source string")
    names = ("Size", "_h", "_kind", "_pieces", "_size", "_row", "_s", "target", "_source")
    docs = plain.selectExpr("*", *[f"doc_id + {k} as `{n}`" for k, n in enumerate(names)])
    counts = {r.doc_id: r.taken for r in mixing.mix_counts(docs).collect() if r.taken}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = collections.Counter()
    for r in out.collect():
        taken[r.doc_id] += len(r.text.split())
        assert [r[n] for n in names] == [r.doc_id + k for k in range(len(names))]
    assert dict(taken) == counts


# ---------------------------------------------------------------------------- WARC
def test_record_index_against_plain_offsets_and_sql(spark, tmp_path):
    import duckdb

    pages = [(i, f"http://h/{i % 7}", f"<p>é{i}</p>" * (i % 9)) for i in range(1500)]
    pages += [(7, "same", "copy")] * 9000 + [(7, f"u{i}", None) for i in range(300)]
    pages += [(None, None, None)] * 3 + [(None, f"n{i}", "x") for i in range(200)] + [(-1, "u", ""), (1500, None, "z" * 200_000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "page_id as File", "url as `offset`", "html as hash")  # clashing names play no part
    index = record_index(warc_records(table), damaged()).collect()
    files = collections.defaultdict(list)
    for i, u, h in pages:
        body = (h or "").encode()
        rec = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'none' if i is None else i}>\r\n"
               f"WARC-Target-URI: {u or ''}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
        sha = hashlib.sha256(rec).hexdigest()
        files[-int(sha[:3], 16) - 1 if i is None else i // 1000].append((i, sha, u, len(rec)))
    want = []
    for f, recs in files.items():
        at = 0
        for i, sha, u, n in sorted(recs, key=lambda r: (r[0] is not None, r[0], r[1])):
            want.append((f, at, n, i, u, sha))
            at += n
    assert sorted(map(str, (tuple(r)[:6] for r in index))) == sorted(map(str, want))
    frame = spark.createDataFrame(index, "file long, `offset` long, length long, page_id long, url string, hash string, "
                                         "replica_hash string")
    bad = compare_replicas(frame.select("file", "offset", "hash"),
                           frame.where("replica_hash is not null").selectExpr("file", "offset", "replica_hash as hash"))
    got = sorted((r.file, r.offset, r.status, r.hash_a, str(r.hash_b)) for r in bad.collect())
    table.select("page_id", "url", "html").write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    sql = con.sql(f'SELECT file, "offset", status, hash_a, hash_b FROM ({OP10_SQL})').fetchall()
    assert got == sorted((f, o, s, a, str(b)) for f, o, s, a, b in sql) and got
    empty = record_index(warc_records(table.limit(0)))
    assert empty.count() == 0
