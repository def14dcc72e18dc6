import json
import os

from pyspark.sql import functions as F

from logscan.operators.uploads import decode_event, encode_event, landing_key, latest_uploads, object_key
from logscan.streaming.uploads_stream import json_line_events, read_catalogue, start_catalogue

EVENTS = [
    {"filePath": "/data/uploads/a.csv", "fileName": "a.csv", "uploadTime": 1700000000000},
    {"filePath": "C:\\data\\uploads\\a.csv", "fileName": "a.csv", "uploadTime": 1700000005000},
    {"filePath": "/x/b.csv", "fileName": "b.csv", "uploadTime": 1700000001000},
    {"filePath": "/y/b.csv", "fileName": "b.csv", "uploadTime": 1700000001000},
]
BAD = ['{"filePath": "/z/c.csv", "fileName": "c.csv"', '{"filePath": "/z/c.csv", "fileName": "c.csv"}']


def test_decode_and_reject(spark):
    df = spark.createDataFrame([(json.dumps(e),) for e in EVENTS] + [(b,) for b in BAD], "value string")
    out = decode_event(df).collect()
    assert [r.is_valid for r in out] == [True] * 4 + [False, False]
    assert str(out[0].upload_ts) == "2023-11-14 22:13:20"


def test_encode_roundtrip(spark):
    df = spark.createDataFrame(EVENTS)
    enc = encode_event(df.select("filePath", "fileName", "uploadTime"))
    back = decode_event(enc).select("filePath", "fileName", "uploadTime").collect()
    assert [r.asDict() for r in back] == [dict(e) for e in EVENTS]


def test_latest_and_keys(spark):
    df = spark.createDataFrame(EVENTS)
    cur = {r.fileName: r for r in latest_uploads(df).collect()}
    assert cur["a.csv"].uploadTime == 1700000005000
    assert cur["b.csv"].filePath == "/y/b.csv"  # equal times: greater path wins
    keys = [r.k for r in df.select(object_key("filePath").alias("k")).collect()]
    assert keys == ["uploads/a.csv", "uploads/a.csv", "uploads/b.csv", "uploads/b.csv"]
    lk = df.select(landing_key("fileName", "uploadTime").alias("k")).first().k
    assert lk == "uploads/1700000000000-a.csv"


def test_catalogue_stream(spark, tmp):
    folder = os.path.join(tmp, "topic")
    os.makedirs(folder)
    with open(os.path.join(folder, "p0.json"), "w") as f:
        f.write("\n".join([json.dumps(e) for e in EVENTS[:1]] + BAD[:1]) + "\n")
    base = os.path.join(tmp, "cat")
    q = start_catalogue(spark, json_line_events(spark, folder), base + "/entries", base + "/rejects",
                        base + "/ckpt")
    q.awaitTermination()
    with open(os.path.join(folder, "p1.json"), "w") as f:
        f.write("\n".join(json.dumps(e) for e in EVENTS[1:]) + "\n")
    q = start_catalogue(spark, json_line_events(spark, folder), base + "/entries", base + "/rejects",
                        base + "/ckpt")
    q.awaitTermination()
    cur = {r.fileName: r for r in read_catalogue(spark, base + "/entries").collect()}
    assert cur["a.csv"].uploadTime == 1700000005000 and cur["a.csv"].object_key == "uploads/a.csv"
    assert cur["b.csv"].filePath == "/y/b.csv"
    assert spark.read.parquet(base + "/rejects").count() == 1


def _topic(folder, part, events):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"p{part:02d}.json")
    with open(path, "w") as f:
        f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))


def _plain_latest(events):
    want = {}
    for e in events:
        got = (e["uploadTime"], e["filePath"])
        want[e["fileName"]] = max(want.get(e["fileName"], got), got)
    return want


def test_catalogue_state_with_late_events_and_restart(spark, tmp):
    from logscan.streaming.uploads_stream import start_catalogue_state, start_rejects

    base, folder = os.path.join(tmp, "cat"), os.path.join(tmp, "topic")
    made = [[{"fileName": f"{n}.csv", "filePath": f"/{b}/{n}", "uploadTime": 100 * ((b * 7) % 4) + n} for n in range(b, b + 6)]
            for b in range(4)]  # batch 2 is older than batch 1 and batch 3 than batch 2 of some names
    for parts in ((0, 1, 2), (3,)):
        for b in parts:
            _topic(folder, b, made[b] + BAD[:1])
        q = start_catalogue_state(spark, json_line_events(spark, folder, 1), base, os.path.join(tmp, "ckpt"))
        q.awaitTermination()
        got = {r.fileName: (r.uploadTime, r.filePath) for r in read_catalogue(spark, base).collect()}
        assert got == _plain_latest([e for b in made[:parts[-1] + 1] for e in b])
    q = start_rejects(json_line_events(spark, folder), os.path.join(tmp, "rej"), os.path.join(tmp, "ckpt2"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "rej")).count() == 4


def test_runs_stay_few_and_replays_replace(spark, tmp):
    from logscan.sources.run_store import KEEP
    from logscan.streaming.uploads_stream import catalogue_store

    path = os.path.join(tmp, "cat")
    store = catalogue_store(spark, path, fanout=3, buckets=2)
    assert store.read() is None and store.lookup(["a"]) is None
    all_events = []

    def batch(b):
        rows = [{"fileName": f"f{(b * k) % 11}", "uploadTime": (b * 13 + k) % 17, "filePath": f"/{b}"} for k in range(5)]
        return list({r["fileName"]: r for r in rows}.values())

    for b in range(12):
        all_events += batch(b)
        for _ in range(2 if b % 4 == 3 else 1):  # every fourth batch is replayed
            m = store.commit(b, spark.createDataFrame(batch(b), "fileName string, uploadTime long, filePath string"))
        levels = [r["level"] for r in m["runs"]]
        assert all(levels.count(k) < 3 for k in levels) and max(levels) <= 2
        got = {r.fileName: (r.uploadTime, r.filePath) for r in store.read().collect()}
        assert got == _plain_latest(all_events)
    assert len(os.listdir(os.path.join(path, "manifest"))) <= 2 * KEEP  # and their checksums
    named = {r["name"] for k in store._manifests() for r in store.manifest(k)["runs"]}
    assert set(os.listdir(os.path.join(path, "runs"))) == named
    assert {r.fileName for r in store.lookup(["f3", "f4", "absent"]).collect()} == {"f3", "f4"} & set(got)
    # a batch that dies before its manifest leaves the state before it
    before = store.manifest()
    store._write_run(spark.createDataFrame([("zz", 99, "/z")], "fileName string, uploadTime long, filePath string"), "12-0")
    assert store.manifest() == before and store.read().where("fileName = 'zz'").count() == 0


def test_upload_events_for_paths(spark):
    import time

    from logscan.operators.uploads import upload_events_for

    before = int(time.time() * 1000)
    paths = spark.createDataFrame([("/data/uploads/a.csv",), ("C:\\up\\b.csv",)], "filePath string")
    ev = upload_events_for(paths).collect()
    assert [r.fileName for r in ev] == ["a.csv", "b.csv"]
    assert all(before - 1000 <= r.uploadTime <= int(time.time() * 1000) + 1000 for r in ev)
    back = decode_event(encode_event(upload_events_for(paths))).collect()
    assert all(r.is_valid for r in back)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv", "c.csv"]), st.integers(0, 3),
                          st.sampled_from(["/x/1", "/x/2", "C:\\y\\3"])), min_size=1, max_size=60))
def test_property_latest_upload(spark, events):
    df = spark.createDataFrame(events, "fileName string, uploadTime long, filePath string").repartition(3)
    got = {r.fileName: (r.uploadTime, r.filePath) for r in latest_uploads(df).collect()}
    want = {}
    for name, t, path in events:
        want[name] = max(want.get(name, (t, path)), (t, path))
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab/\\.c:1 ", max_size=20), min_size=1, max_size=30))
def test_property_object_key(spark, paths):
    import re

    df = spark.createDataFrame([(p,) for p in paths], "filePath string")
    got = [r.k for r in df.select(object_key("filePath").alias("k")).collect()]
    assert got == ["uploads/" + re.split(r"[/\\]", p)[-1] for p in paths]
