"""Physical-plan checks for the properties that matter at scale."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscan.operators import prepare as P
from logscan.operators.score import rank_one_model
from logscan.operators.uploads import latest_uploads
from logscan.plans.detect import detect
from logscan.session import spread
from logscan.sources.logs import read_logs
from test_sources import LINES, write_logs

MODEL = rank_one_model(768, lambda d: ((d * 7) % 11 - 5) / 40.0)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _many_files(spark, tmp):
    folder = os.path.join(tmp, "many")
    for i in range(spark.sparkContext.defaultParallelism + 2):
        write_logs(folder, f"{i}.csv", LINES)
    return read_logs(spark, folder)


def test_detect_has_no_shuffle_on_split_input(spark, tmp):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # one small file per split,
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")    # as large inputs arrive
    try:
        logs = _many_files(spark, tmp)
        assert logs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        plan = _plan(detect(logs, MODEL, 0.001))
        assert "Exchange" not in plan
        assert plan.count("ArrowEvalPython") == 1  # every line scored once, not again for the filter
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_spread_only_on_request(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one) is one
    assert "RoundRobinPartitioning(5)" in _plan(spread(one, 5))


def test_partial_aggregation_before_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.concat(F.lit("f"), (F.col("user_id") % 3).cast("string")).alias("fileName"),
        F.col("event_id").alias("uploadTime"), F.lit("/p").alias("filePath"))
    plan = _plan(latest_uploads(ev))
    assert "partial_max" in plan and plan.index("partial_max") > plan.index("Exchange")
    d = P.dedupe(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text"))
    dplan = _plan(d)
    assert dplan.count("HashAggregate") >= 2


def test_threshold_table_is_a_scalar_subquery(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("recon_error"))
    t = spark.createDataFrame([(10.0,)], "threshold double")
    out = P.threshold_filter(df, t)
    plan = _plan(out)
    assert "Subquery" in plan and "Join" not in plan
    assert out.count() == 989
