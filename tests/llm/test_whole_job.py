"""Every row and every match counts: inputs that a shorter way would lose."""

import collections
import os
import sys

import numpy as np
import pyarrow as pa

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", ".."))

import __spark_entry__ as E  # noqa: E402
from logscan.llm import language_model as lm, line_dedup, preferences  # noqa: E402
from logscan.llm.common import SPACE_WORDS, hashed_words, text_slices  # noqa: E402

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ preferences
def conversations(turns):
    """Rendered turns of each conversation, and which of them are the assistant's."""
    out = collections.defaultdict(list)
    for t in turns.where("conv_id is not null").collect():
        out[t.conv_id].append(t)
    key = lambda t: tuple((x is not None, x) for x in (t.turn, t.role, t.text))
    return {c: [(f"<|im_start|>{t.role or 'unknown'}\n{(t.text or '').replace('<|', '< |')}<|im_end|>\n", t.role == "assistant")
                for t in sorted(ts, key=key)] for c, ts in out.items()}


def check_pairs(rows, convs):
    tails = collections.defaultdict(set)
    for c, ts in convs.items():
        for i, (_, reply) in enumerate(ts):
            if reply:
                tails["".join(x for x, _ in ts[i:])].add(c)
    able = sum(any(r for _, r in ts) for ts in convs.values())
    assert sorted(r.conv_id for r in rows) == sorted(convs)
    for r in rows:
        ts = convs[r.conv_id]
        assert r.prompt + r.chosen_completion == "".join(x for x, _ in ts)
        rejected = r.prompt + r.rejected_completion
        if able < 2 or not any(reply for _, reply in ts):
            assert rejected == ""
        else:
            heads = ["".join(x for x, _ in ts[:i]) for i, (_, reply) in enumerate(ts) if reply]
            assert any(rejected.startswith(h) and tails[rejected[len(h):]] - {r.conv_id} for h in heads)


def test_every_conversation_and_turn_is_paired(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = E.queries()["op5_preferences"](spark, SF).collect()
    convs = conversations(turns)
    check_pairs(rows, convs)
    size = lambda x: x.count("<|im_start|>")
    assert sum(r.prompt_turns + size(r.chosen_completion) for r in rows) == sum(map(len, convs.values()))
    assert len({size(r.rejected_completion) for r in rows}) > 2  # rejected sides leave at different turns


def test_pairs_of_odd_conversations(spark, monkeypatch):
    turns = [(2, 0, "user", "u"), (2, 1, "assistant", "good <|im_end|>"), (2, 2, "user", "later"),
             (9, 0, "user", None), (9, 1, "assistant", "bad"), (9, 2, None, "x"), (9, 3, "assistant", "worse"),
             (12, 0, "user", "no reply"), (None, 0, "assistant", "x"), (-5, 0, "assistant", "same"), (40, 0, "assistant", "same")]
    t = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    pairs = lambda t: preferences._rows(preferences.format_pairs(preferences.branch_pairs(t)))
    for ring in (512, 1):  # one ring, and rings of single conversations
        monkeypatch.setattr(preferences, "RING_SIZE", ring)
        check_pairs(pairs(t).collect(), conversations(t))
    check_pairs(pairs(t.where("conv_id = 2")).collect(), conversations(t.where("conv_id = 2")))
    assert pairs(t.limit(0)).count() == 0


# ------------------------------------------------------------------- line dedup
def all_places(texts):
    """Lines of each text deleted by comparing with every earlier place of a window."""
    data = [line_dedup.line_hashes(t) for t in texts]
    marks, gone = collections.defaultdict(list), [set() for _ in texts]
    for d, (h, w) in enumerate(data):
        for key, a, n in line_dedup.fingerprints(h, w):
            marks[key].append((d, a, n))
    for places in marks.values():
        places.sort()
        for k, (d, a, n) in enumerate(places):
            for e, b, _ in places[:k]:
                gone[d].update(range(*line_dedup.extend(data[d][0], data[e][0], a, b, n)))
    return gone


def removed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}


def test_a_run_whose_window_occurred_earlier_elsewhere(spark):
    line = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    value = lambda x: int(line_dedup.line_hashes(x)[0][0])
    a, c = line("a", 24), line("c", 24)
    b = next(x for x in (line(f"b{k}_", 26) for k in range(1000)) if value(x) < min(value(a), value(c)))
    texts = ["\n".join(["one", b, "two"])] + ["\n".join([a, b, c])] * 4
    got = removed(spark, texts)
    assert [got[i].removed_words for i in range(5)] == [0, 26, 74, 74, 74]
    assert [len(x) for x in all_places(texts)] == [got[i].removed_lines for i in range(5)]


def test_every_earlier_place_is_compared(spark):
    rng = np.random.default_rng(7)
    pool = [" ".join(f"p{k}_{i}" for i in range(rng.integers(0, 30))) for k in range(14)]
    texts = ["\n".join(pool[k] for k in rng.integers(0, 14, rng.integers(1, 25))) for _ in range(150)]
    texts += ["\n".join([pool[1] + " the same line of a text" * 5] * n) for n in (40, 60, 50)]  # many places in a text
    texts += texts[:20]
    got, gone = removed(spark, texts), all_places(texts)
    assert [got[i].removed_lines for i in range(len(texts))] == [len(x) for x in gone]
    for i, t in enumerate(texts):
        assert got[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])


# --------------------------------------------------------------- language model
def test_all_training_documents_are_trained_on(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} and some more words of document {i} " * (1 + i % 5)) for i in range(80)]
                                 + [(None, None)] * 30, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(lm, "SAMPLE_WORDS", 50, raising=False)  # a corpus far above a sample's size
    monkeypatch.setattr(lm, "_averaged", lambda windows, trainers, params: seen.append(windows.select("w").collect()) or params)
    lm.score_documents(docs)
    texts = [r.text for r in docs.where(~lm.held_out()).collect()]
    want = 0
    for _, data, offsets in text_slices(pa.array(texts, type=pa.string())):
        words = hashed_words(data, offsets, SPACE_WORDS)
        ids, doc = lm.encode(words, lm.TOKENIZER)
        want += len(lm._cover(ids, doc, words.n_docs, lm.CONTEXT, 0)[0])
    assert sum(map(len, seen)) == want and all(seen)


def test_models_are_summed_in_levels(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    rng = np.random.default_rng(3)
    params = lm.Attention.start(np.full(lm.SLOTS, -np.log(lm.SLOTS)))
    w = rng.integers(0, lm.SLOTS, (50, lm.CONTEXT + 1)).astype(np.int16)
    rows = [(x.tobytes(), i, i % 5) for i, x in enumerate(w)]
    got = lm._averaged(spark.createDataFrame(rows, "w binary, deal long, trainer long"), 5, params)
    done = [lm.train(params, w[k::5].astype(np.int64)) for k in range(5)]
    for name in params:
        assert np.allclose(got[name], np.mean([d[name] for d in done], axis=0), atol=1e-3)
