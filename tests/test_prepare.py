import math

from pyspark.sql import functions as F

from logscan.operators import prepare as P
from logscan.schema import LOG_SCHEMA

ROW = (0, None, "WARNING", "ServiceA", "Performance Warnings", 6743, "User96", "192.168.1.102", "28ms")


def _logs(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_drop_rules(spark):
    rows = [
        ROW,
        (1, None, "INFO", "ServiceB", None, 1, "User1", "1.1.1.1", "10ms"),      # null message: kept
        (2, None, None, "ServiceB", "x", 2, "User1", "1.1.1.1", "10ms"),          # null level: dropped
        (3, None, "INFO", "ServiceB", "x", 3, "User1", "1.1.1.1", "nanms"),       # NaN time: dropped
        (4, None, "INFO", "ServiceB", "x", 4, "User1", "1.1.1.1", None),          # null time: 0.0 kept
        (5, None, "INFO", None, "x", 5, "User1", "1.1.1.1", "10ms"),              # null service: dropped
        (6, None, "INFO", "ServiceC", "x", 6, "User1", "1.1.1.1", "1e40ms"),      # inf: kept
    ]
    out = P.drop_incomplete(P.prepare(_logs(spark, rows))).orderBy("RequestID").collect()
    assert [r.RequestID for r in out] == [1, 4, 6, 6743]
    by = {r.RequestID: r for r in out}
    assert by[1].Message == "None"
    assert by[4].TimeVal == 0.0
    assert math.isinf(by[6].TimeVal)
    assert "_c0" not in P.prepare(_logs(spark, rows)).columns


def test_row_id_and_dedupe(spark):
    df = P.prepare(_logs(spark, [ROW, ROW]))
    with_id = P.with_row_id(df)
    assert with_id.select("row_id").distinct().count() == 2
    assert P.dedupe(with_id).count() == 2  # row_id among the columns: lines stay
    assert P.dedupe(df).count() == 1
    assert P.dedupe(with_id, on=["Message", "TimeVal"]).count() == 1


def test_threshold_strict_and_table(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.0005610922235064209), (3, 0.0006)], "id int, recon_error double")
    thr = 0.0005610922235064209
    assert [r.id for r in P.threshold_filter(df, thr).orderBy("id").collect()] == [1, 3]
    t = spark.createDataFrame([(thr,)], "threshold double")
    assert [r.id for r in P.threshold_filter(df, t).orderBy("id").collect()] == [1, 3]
    import pytest
    with pytest.raises(Exception):  # a scalar subquery with two rows fails at run time
        P.threshold_filter(df, spark.createDataFrame([(1.0,), (2.0,)], "threshold double")).collect()


def test_top_k_plan_and_order(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("recon_error"))
    top = P.top_k(df, 3, tie_break=["id"])
    assert [(r.id, r.recon_error) for r in top.collect()] == [(96, 96.0), (193, 96.0), (290, 96.0)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_text_and_result_columns(spark):
    df = P.scorable_lines(_logs(spark, [ROW]))
    r = df.first()
    assert r.text == "LOGLEVEL=WARNING SERVICE=ServiceA TIME=28.0 TEXT=Performance Warnings"
    scored = df.withColumn("recon_error", F.lit(1.0))
    assert P.result_columns(scored).columns == [
        "Timestamp", "LogLevel", "Service", "Message", "RequestID", "User", "ClientIP", "TimeTaken",
        "TimeVal", "recon_error"]
    assert P.schema_report(df).startswith("root")


def test_raw_drop_equals_prepared_drop(spark):
    from conftest import SF_SMALL
    from logscan.plans.queries import logs_view

    dirty = logs_view(spark, SF_SMALL, dirty=True)
    a = P.drop_incomplete(P.prepare(dirty))
    b = P.prepare(P.drop_incomplete_raw(dirty))
    cols = ["RequestID", "LogLevel", "Service", "Message", "TimeVal"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    rows = [ROW, (7, None, "INFO", "S", None, 8, "U", "1.1.1.1", " NaN ms"), (8, None, "INFO", "S", "m", 9, "U", "1", None)]
    df = _logs(spark, rows)
    assert sorted(P.drop_incomplete(P.prepare(df)).select("RequestID").collect()) == \
        sorted(P.prepare(P.drop_incomplete_raw(df)).select("RequestID").collect())


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_maybe = lambda s: st.one_of(st.none(), s)
_time = st.one_of(st.sampled_from(["nanms", "NaN", " -nan ms", "infms", "28ms", "bad", "", "1e400ms", "nan\\n"]),
                  st.text(alphabet="0123456789.nNaAiIfms +-", max_size=8))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(_maybe(st.sampled_from(["INFO", "ERROR"])), _maybe(st.sampled_from(["A", "B"])),
                          _maybe(st.text(alphabet="User0123. ", max_size=12)), _maybe(_time)),
                min_size=1, max_size=30))
def test_property_raw_drop(spark, rows):
    data = [(i, None, lv, sv, m, i, "U", "ip", t) for i, (lv, sv, m, t) in enumerate(rows)]
    df = _logs(spark, data)
    a = sorted(r.RequestID for r in P.drop_incomplete(P.prepare(df)).collect())
    b = sorted(r.RequestID for r in P.prepare(P.drop_incomplete_raw(df)).collect())
    assert a == b


def test_keep_raw_message(spark):
    row = (0, None, "INFO", "S", "User5 at 10.1.2.3", 1, "U", "ip", "5ms")
    r = P.prepare(_logs(spark, [row]), keep_raw=True).first()
    assert r.Message == "[USER] at [IP]" and r.RawMessage == "User5 at 10.1.2.3"
