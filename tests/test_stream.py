import os

from pyspark.sql import functions as F

from logscan.operators.score import rank_one_model
from logscan.operators.stats import METRIC_NAMES
from logscan.plans.detect import detect
from logscan.sources.logs import read_logs
from logscan.streaming.detect_stream import batch_writer, finish_metrics, start_detect_stream
from test_sources import HEADER, LINES, write_logs



def token_model(weight):
    model = rank_one_model(768, weight)
    model.meta = {"features": "tokens", "dim": 768}
    return model


MODEL = token_model(lambda d: ((d * 7) % 11 - 5) / 40.0)


def _run(spark, folder, out, ckpt, thr, archive=None):
    q = start_detect_stream(spark, folder, MODEL, thr, out + "/res", ckpt, metrics_path=out + "/met",
                            available_now=True, fmt="parquet", archive_dir=archive)
    q.awaitTermination()
    finish_metrics(q)
    return q


def test_stream_equals_batch_and_restart(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "1-a.csv", LINES)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    thr = 0.0012
    _run(spark, folder, out, ckpt, thr)
    res = spark.read.parquet(out + "/res")
    batch = detect(read_logs(spark, folder), MODEL, thr)
    cols = ["RequestID", "Message", "TimeVal", "recon_error"]
    assert sorted(res.select(cols).collect()) == sorted(batch.select(cols).collect())
    n1 = res.count()
    # restart on the same checkpoint with no new file: nothing new
    _run(spark, folder, out, ckpt, thr)
    assert spark.read.parquet(out + "/res").count() == n1
    # a new file is read once, in a new batch
    write_logs(folder, "2-b.csv", LINES[:2])
    _run(spark, folder, out, ckpt, thr)
    res2 = spark.read.parquet(out + "/res")
    assert res2.select("batch_id").distinct().count() == 2
    met = spark.read.parquet(out + "/met")
    assert met.count() == 10 and met.select("run_id").distinct().count() == 2
    for batch in (0, 1):
        got = {r.metric_name: r.metric_value for r in met.where(F.col("batch_id") == batch).collect()}
        assert sorted(got) == sorted(METRIC_NAMES)
        assert 0 < got["detect_sec"] <= got["duration_sec"]


def test_replayed_batch_is_idempotent(spark, tmp):
    folder = os.path.join(tmp, "in")
    write_logs(folder, "a.csv", LINES)
    logs = read_logs(spark, folder)
    out = os.path.join(tmp, "out")
    fn = batch_writer(MODEL, 0.0, out + "/res", out + "/met", fmt="parquet")
    fn(logs, 0)
    fn(logs, 0)  # replay of batch 0
    fn(logs, 1)
    res = spark.read.parquet(out + "/res")
    assert res.where("batch_id = 0").count() == 4 and res.count() == 8
    assert spark.read.parquet(out + "/met").count() == 6


def test_archive_clean_source(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    archive = os.path.join(tmp, "archive")
    write_logs(folder, "1-a.csv", LINES)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    _run(spark, folder, out, ckpt, 0.0, archive)
    write_logs(folder, "2-b.csv", LINES)
    _run(spark, folder, out, ckpt, 0.0, archive)
    _run(spark, folder, out, ckpt, 0.0, archive)
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "1-a.csv" in archived
    assert spark.read.parquet(out + "/res").count() == 8


def test_dedupe_within_watermark(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "1-a.csv", LINES + LINES[:2])  # two repeated lines
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    q = start_detect_stream(spark, folder, MODEL, 0.0, out + "/res", ckpt, available_now=True, fmt="parquet",
                            dedupe_within="1 hour")
    q.awaitTermination()
    assert spark.read.parquet(out + "/res").count() == 4


def test_archive_inside_source_is_refused(spark, tmp):
    import pytest
    from logscan.sources.logs import stream_logs

    with pytest.raises(ValueError):
        stream_logs(spark, os.path.join(tmp, "in"), archive_dir=os.path.join(tmp, "in", "done"))


def test_max_files_per_trigger(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    for i in range(3):
        write_logs(folder, f"{i}.csv", LINES)
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    q = start_detect_stream(spark, folder, MODEL, 0.0, out + "/res", ckpt, available_now=True, fmt="parquet",
                            max_files_per_trigger=1)
    q.awaitTermination()
    res = spark.read.parquet(out + "/res")
    assert res.select("batch_id").distinct().count() == 3 and res.count() == 12


def test_running_stream_uses_new_model_versions(spark, tmp):
    import pytest
    from logscan.sources.model_store import current_version, load_model, make_current, save_model

    store, folder = os.path.join(tmp, "model"), os.path.join(tmp, "uploads")
    assert current_version(spark, store) is None
    first = save_model(spark, MODEL, 1e9, store)  # nothing is above
    write_logs(folder, "0.csv", LINES)
    out = os.path.join(tmp, "out")
    q = start_detect_stream(spark, folder, store, None, out + "/res", os.path.join(tmp, "ckpt"), fmt="parquet",
                            trigger="0 seconds", metrics_path=out + "/met")
    q.processAllAvailable()
    second = save_model(spark, token_model(lambda d: 0.01), 0.0, store)
    write_logs(folder, "1.csv", LINES)
    q.processAllAvailable()
    make_current(spark, store, first)
    write_logs(folder, "2.csv", LINES)
    q.processAllAvailable()
    q.stop()
    finish_metrics(q)
    assert current_version(spark, store) == first
    res = spark.read.parquet(out + "/res")
    assert {r.batch_id for r in res.collect()} == {1} and res.count() == 4
    want = detect(read_logs(spark, folder), load_model(spark, store, second)[0], 0.0).select("recon_error").distinct()
    assert {round(r.recon_error, 12) for r in res.collect()} == {round(r.recon_error, 12) for r in want.collect()}
    met = spark.read.parquet(out + "/met")
    assert met.count() == 15 and met.where("metric_name LIKE '%_sec'").count() == 6
    with pytest.raises(Exception):  # only versions that exist become current
        make_current(spark, store, "no-such-version")


def test_save_that_dies_leaves_the_old_version(spark, tmp, monkeypatch):
    import pytest
    from logscan.sources import model_store as store

    path = os.path.join(tmp, "model")
    store.save_model(spark, token_model(lambda d: 0.25), 0.5, path)
    with monkeypatch.context() as m:  # dies between layers and manifest
        m.setattr(store, "make_current", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.save_model(spark, MODEL, 0.75, path)
    assert len(os.listdir(os.path.join(path, "versions"))) == 2
    model, thr = store.load_model(spark, path)
    assert thr == 0.5 and model.ws[0][0][0] == 0.25
    # a plain folder (layers and threshold, no manifest) is read as before
    old = os.path.join(path, "versions", store.current_version(spark, path))
    assert store.load_model(spark, old)[1] == 0.5


def _turned(folder, name, line):
    names = HEADER.strip().split(",")[1:]
    with open(os.path.join(folder, name), "w") as f:
        f.write(",".join(reversed(names)) + "\n" + ",".join(reversed(line.split(",")[1:])) + "\n")


def test_replaced_file_is_read_again_by_header(spark, tmp):
    folder, archive, out = (os.path.join(tmp, d) for d in ("uploads", "archive", "out"))
    ckpt = os.path.join(tmp, "ckpt")

    def run(archive_dir=None):
        q = start_detect_stream(spark, folder, MODEL, -1.0, out + "/res", ckpt, metrics_path=out + "/met", fmt="parquet",
                                available_now=True, file_events=True, archive_dir=archive_dir)
        q.awaitTermination()
        finish_metrics(q)
        return spark.read.parquet(out + "/res") if os.path.isdir(out + "/res") else None

    assert run() is None  # a folder that is not there yet
    write_logs(folder, "a.csv", LINES)
    write_logs(os.path.join(folder, "_tmp"), "b.csv", LINES)
    assert run().count() == 4
    assert run().count() == 4  # nothing new
    _turned(folder, "a.csv", LINES[5])
    res = run()
    assert res.count() == 5 and res.where("LogLevel = 'FATAL'").select("batch_id").distinct().count() == 2
    write_logs(os.path.join(folder, "day"), "a.csv", LINES[:1])
    assert run(archive).count() == 6
    write_logs(folder, "c.csv", LINES[:1])
    assert run(archive).count() == 7  # the batch before is archived when this one is planned
    kept = sorted(f for _, _, fs in os.walk(archive) for f in fs)
    assert "a.csv" in kept and spark.read.parquet(out + "/met").select("batch_id").distinct().count() == 4


def test_file_events_of_listings():
    from logscan.sources.file_events import new_entries

    a = {"x": [1, 5], "y": [2, 5]}
    assert new_entries({}, a) == [("x", 1, 5), ("y", 2, 5)]
    assert new_entries(a, a) == []
    assert new_entries(a, {"x": (1, 5), "y": (2, 6), "z": (3, 1)}) == [("y", 2, 6), ("z", 3, 1)]
    assert new_entries(a, {}) == []
