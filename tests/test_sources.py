import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import REF_DATA
from logscan.operators.score import Model, rank_one_model
from logscan.plans.detect import detect, run_batch
from logscan.sources.logs import read_logs
from logscan.sources.model_store import load_model, save_model
from logscan.sources.sinks import append_metrics, create_metric_table, truncate_metric_table, write_csv
from logscan.operators.stats import metrics_long, run_counts

HEADER = ",Timestamp,LogLevel,Service,Message,RequestID,User,ClientIP,TimeTaken\n"
LINES = [
    "0,2025-03-04T10:11:12.131415,WARNING,ServiceA,queue is long,5101,User41,172.16.0.9,31ms",
    "1,2025-03-04T10:11:13.000007,DEBUG,ServiceA,User12 from 172.16.0.10,5102,User42,172.16.0.11,62ms",
    "2,2025-03-04T10:11:14.000001,ERROR,ServiceB,,5103,User42,172.16.0.11,",
    "3,2025-03-04T10:11:15.5,,ServiceB,lost level,5104,User42,172.16.0.11,10ms",
    "4,2025-03-04T10:11:16.000000,INFO,ServiceC,nan time,5105,User42,172.16.0.11,nanms",
    "5,2025-03-04T10:11:17.123456,FATAL,ServiceD,odd time,5106,User42,172.16.0.11,1_000ms",
]


def write_logs(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write(HEADER + "\n".join(lines) + "\n")
    return p


def test_read_declared_schema_and_missing(spark, tmp):
    folder = os.path.join(tmp, "in")
    write_logs(folder, "a.csv", LINES)
    df = read_logs(spark, folder)
    assert df.count() == len(LINES)
    r = df.where("RequestID = 5101").first()
    assert r.Timestamp.microsecond == 131415 and r.TimeTaken == "31ms"
    empty = read_logs(spark, os.path.join(tmp, "absent"))
    assert empty.count() == 0 and empty.columns == df.columns


@pytest.mark.skipif(not REF_DATA or not os.path.isdir(REF_DATA), reason="LOGSCAN_SAMPLE_DIR not set")
def test_reference_samples(spark):
    df = read_logs(spark, os.path.join(REF_DATA, "partlogdata.csv"))
    counts = {r.LogLevel: r["count"] for r in df.groupBy("LogLevel").count().collect()}
    assert counts == {"DEBUG": 29, "INFO": 27, "WARNING": 29, "ERROR": 25, "FATAL": 11}
    assert read_logs(spark, REF_DATA).count() == 121 + 165 + 101 + 196


def test_csv_sink_keeps_microseconds(spark, tmp):
    df = read_logs(spark, write_logs(os.path.join(tmp, "in"), "a.csv", LINES[:1]))
    out = os.path.join(tmp, "out")
    write_csv(df, out, mode="overwrite", single_file=True)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert "2025-03-04T10:11:12.131415" in text
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1


def test_metric_table(spark, tmp):
    create_metric_table(spark, "logs_t.metrics", location=os.path.join(tmp, "m"))
    cnt = spark.createDataFrame([(10, 2, 0.2)], "total_logs bigint, anomalies_count bigint, anomalies_ratio double")
    append_metrics(metrics_long(cnt, "run-1", timings={"duration_sec": 1.5, "detect_sec": 0.5}, with_time=False),
                   "logs_t.metrics")
    rows = spark.table("logs_t.metrics").collect()
    assert sorted(r.metric_name for r in rows) == sorted(
        ["total_logs", "anomalies_count", "anomalies_ratio", "duration_sec", "detect_sec"])
    assert all(r.event_time is not None and r.stage == "SparkProcess" for r in rows)
    truncate_metric_table(spark, "logs_t.metrics")
    assert spark.table("logs_t.metrics").count() == 0


def test_model_store_roundtrip(spark, tmp):
    m = Model.init((16, 4, 16), seed=3)
    save_model(spark, m, 0.0005610922235064209, os.path.join(tmp, "model"))
    back, thr = load_model(spark, os.path.join(tmp, "model"))
    assert thr == 0.0005610922235064209
    x = np.random.default_rng(1).normal(size=(4, 16))
    assert np.allclose(back.errors(x), m.errors(x))


def test_run_batch_end_to_end(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "a.csv", LINES)
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)
    scores = detect(read_logs(spark, folder), model, -1.0)  # everything above
    assert scores.count() == 4  # rows 3 (no level) and 4 (NaN time) dropped
    assert {r.Message for r in scores.collect()} >= {"None", "[USER] from [IP]"}
    res = run_batch(spark, folder, model, 0.0, os.path.join(tmp, "res"), metrics_path=os.path.join(tmp, "met"),
                    consume=True, archive_dir=os.path.join(tmp, "archive"))
    assert res["status"] == "ok" and res["total_logs"] == 4.0
    assert os.listdir(folder) == []
    assert os.listdir(os.path.join(tmp, "archive", res["run_id"])) == ["a.csv"]
    met = spark.read.parquet(os.path.join(tmp, "met"))
    assert met.count() == 5
    again = run_batch(spark, folder, model, 0.0, os.path.join(tmp, "res"))
    assert again["status"] == "no_input"
    assert run_batch(spark, os.path.join(tmp, "nowhere"), model, 0.0, os.path.join(tmp, "res"))["status"] == "no_input"


def test_threshold_text(spark, tmp):
    from logscan.sources.model_store import read_threshold_text, write_threshold_text

    p = os.path.join(tmp, "thr.txt")
    with open(p, "w") as f:
        f.write("0.0005610922235064209")
    assert read_threshold_text(spark, p) == 0.0005610922235064209
    write_threshold_text(spark, 0.25, os.path.join(tmp, "thr_out"))
    assert read_threshold_text(spark, os.path.join(tmp, "thr_out")) == 0.25


def test_run_batch_with_row_id(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "a.csv", LINES)
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)
    res = run_batch(spark, folder, model, -1.0, os.path.join(tmp, "res"), with_row_id=True)
    out = spark.read.option("header", True).csv(os.path.join(tmp, "res"))
    assert res["status"] == "ok" and out.columns[0] == "row_id" and out.count() == 4


def test_columns_bound_by_header(spark, tmp):
    folder = os.path.join(tmp, "mixed")
    write_logs(folder, "full.csv", LINES[:1])
    with open(os.path.join(folder, "plain.csv"), "w") as f:  # no index column
        f.write(HEADER.lstrip(",") + LINES[1].split(",", 1)[1] + "\n")
    names = HEADER.strip().split(",")
    with open(os.path.join(folder, "turned.csv"), "w") as f:  # columns in another order
        f.write(",".join(reversed(names[1:])) + "\n" + ",".join(reversed(LINES[5].split(",")[1:])) + "\n")
    rows = {r.RequestID: r for r in read_logs(spark, folder).collect()}
    assert sorted(rows) == [5101, 5102, 5106]
    assert rows[5101]["_c0"] == 0 and rows[5102]["_c0"] is None
    assert (rows[5106].LogLevel, rows[5106].Service, rows[5106].TimeTaken) == ("FATAL", "ServiceD", "1_000ms")
    with open(os.path.join(folder, "short.csv"), "w") as f:
        f.write("Timestamp,LogLevel\n2025-03-04T10:11:12,INFO\n")
    with pytest.raises(ValueError, match="missing"):
        read_logs(spark, folder)


def jobs_of(spark, group, run):
    """Number of Spark jobs that ``run`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_start_few_jobs(spark, tmp):
    folder = os.path.join(tmp, "many")
    for i in range(500):
        write_logs(folder, f"{i}.csv", [f"{i}" + LINES[0][1:]])
    df = {}
    assert jobs_of(spark, "many", lambda: df.update(n=read_logs(spark, folder).count())) <= 3
    assert df["n"] == 500
    with open(os.path.join(folder, "plain.csv"), "w") as f:
        f.write("\n" + HEADER.lstrip(",") + LINES[1].split(",", 1)[1] + "\n")
    open(os.path.join(folder, "empty.csv"), "w").close()
    assert jobs_of(spark, "mixed", lambda: df.update(rows=read_logs(spark, folder).collect())) <= 4  # one lists the files
    assert len(df["rows"]) == 501
    assert [r.LogLevel for r in df["rows"] if r["_c0"] is None] == ["DEBUG"]


def test_scan_checks_headers_and_run_binds_them(spark, tmp):
    from logscan.sources.logs import is_header_mismatch

    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "a.csv", LINES)
    names = HEADER.strip().split(",")
    with open(os.path.join(folder, "turned.csv"), "w") as f:
        f.write(",".join(reversed(names[1:])) + "\n" + ",".join(reversed(LINES[5].split(",")[1:])) + "\n")
    with pytest.raises(Exception) as e:
        read_logs(spark, folder, headers="scan").collect()
    assert is_header_mismatch(e.value)
    with pytest.raises(ValueError):
        read_logs(spark, folder, headers="maybe")
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)
    res = run_batch(spark, folder, model, -1.0, os.path.join(tmp, "res"), consume=True)
    assert res["status"] == "ok" and res["total_logs"] == 5.0  # four lines of a.csv, one of turned.csv
    out = spark.read.option("header", True).csv(os.path.join(tmp, "res"))
    assert out.count() == 5 and out.where("LogLevel = 'FATAL'").count() == 2
    assert os.listdir(folder) == []


def test_headers_with_other_case_quotes_and_repeats(spark, tmp):
    folder = os.path.join(tmp, "in")
    os.makedirs(folder)
    names = HEADER.strip().split(",")[1:]
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("extra," + ",".join(f'"{n.upper()}"' for n in names) + ",Extra,message\n"
                "x," + LINES[0].split(",", 1)[1] + ",y,other\n")
    row, = read_logs(spark, folder).collect()
    assert (row["_c0"], row.LogLevel, row.Message, row.TimeTaken) == (None, "WARNING", "queue is long", "31ms")
    open(os.path.join(folder, "a.csv"), "w").close()
    assert read_logs(spark, folder).collect() == []


def test_missing_path_in_a_list_raises(spark, tmp):
    from pyspark.errors import AnalysisException

    p = write_logs(os.path.join(tmp, "in"), "a.csv", LINES)
    with pytest.raises(AnalysisException):
        read_logs(spark, [p, os.path.join(tmp, "absent")])
    assert read_logs(spark, [p]).count() == len(LINES)


def test_inputs_stay_when_metrics_fail(spark, tmp):
    folder = os.path.join(tmp, "uploads")
    write_logs(folder, "a.csv", LINES)
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)
    with pytest.raises(Exception):
        run_batch(spark, folder, model, 0.0, os.path.join(tmp, "res"), metrics_table="no_such_db.no_table", consume=True)
    assert os.listdir(folder) == ["a.csv"]


def test_archive_keeps_equal_names_apart(spark, tmp):
    from logscan.plans.detect import delete_inputs

    root = os.path.join(tmp, "uploads")
    files = [write_logs(os.path.join(root, d), "same.csv", LINES) for d in ("x", "y")]
    assert delete_inputs(spark, files, os.path.join(tmp, "archive"), root) == 2
    assert sorted(os.listdir(os.path.join(tmp, "archive"))) == ["x", "y"]
    write_logs(os.path.join(root, "x"), "same.csv", LINES)
    with pytest.raises(OSError):  # an archived file is never overwritten
        delete_inputs(spark, files[:1], os.path.join(tmp, "archive"), root)


class Killed(Exception):
    pass


def _kill(*args, **kwargs):
    raise Killed


@pytest.mark.parametrize("point", ["write", "commit", "after", "metrics", "inputs", "done"])
def test_staged_run_killed_anywhere_leaves_each_row_once(spark, tmp, monkeypatch, point):
    from logscan.plans import detect as plan
    from logscan.sources.staged import RESULT_SCHEMA, StagedResults

    folder, out = os.path.join(tmp, "uploads"), os.path.join(tmp, "res")
    write_logs(folder, "a.csv", LINES)
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)

    def run(**more):
        return run_batch(spark, folder, model, -1.0, out, metrics_path=os.path.join(tmp, "met"), staged=True, consume=True,
                         archive_dir=os.path.join(tmp, "archive"), **more)

    with monkeypatch.context() as m:
        if point in ("commit", "done"):
            m.setattr(StagedResults, {"commit": "commit", "done": "finish"}[point], _kill)
        elif point == "write":  # rows half written: a folder without a manifest
            real = StagedResults.write
            m.setattr(StagedResults, "write", lambda self, *a: (real(self, *a), _kill()))
        elif point in ("metrics", "inputs"):
            m.setattr(plan, {"metrics": "_store_metrics", "inputs": "delete_inputs"}[point], _kill)
        with pytest.raises(Killed):
            run(after_commit=_kill if point == "after" else None)
    write_logs(folder, "b.csv", LINES[:2])  # arrives before the run starts again
    assert run()["status"] == "ok"
    assert run()["status"] == "no_input"
    res = StagedResults(spark, out).read(RESULT_SCHEMA)
    assert sorted(r.RequestID for r in res.collect()) == [5101, 5101, 5102, 5102, 5103, 5106]
    assert res.where("Timestamp IS NULL OR recon_error IS NULL").count() == 0
    assert os.listdir(folder) == []
    met = spark.read.parquet(os.path.join(tmp, "met"))
    assert met.groupBy("run_id", "metric_name").count().where("count > 1").count() == 0
    assert met.where("metric_name = 'total_logs'").groupBy().sum("metric_value").first()[0] == 6.0
    assert len(os.listdir(os.path.join(out, "runs"))) == len(StagedResults(spark, out).committed())


def test_staged_run_without_consuming_reads_a_file_once(spark, tmp):
    folder, out = os.path.join(tmp, "uploads"), os.path.join(tmp, "res")
    write_logs(folder, "a.csv", LINES)
    model = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)

    def run():
        return run_batch(spark, folder, model, -1.0, out, staged=True)

    assert (run()["total_logs"], run()["status"]) == (4.0, "no_input")
    write_logs(folder, "a.csv", LINES[:1] * 2)  # replaced: other length
    assert run()["total_logs"] == 2.0


def test_bucketed_tables_join_in_place(spark, tmp):
    from logscan.operators.join import attach_scores, write_bucketed

    spark.sql(f"CREATE DATABASE IF NOT EXISTS join_t LOCATION '{tmp}/db'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(1000).selectExpr("id % 900 as row_id", "cast(id as string) as Message", "1.5 as TimeVal")
        scores = spark.range(0, 2000, 3).selectExpr("id as row_id", "id / 7.0 as recon_error")
        got = attach_scores(write_bucketed(lines, "join_t.lines", buckets=4), write_bucketed(scores, "join_t.scores", buckets=4))
        want = attach_scores(lines, scores)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE join_t CASCADE")
