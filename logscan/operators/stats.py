"""Aggregations over scores: counts, summaries, thresholds, epoch history.

All are global or per-epoch aggregates with partial (map-side) aggregation;
percentiles are exact and go through ``quantile.exact_quantiles``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscan.operators.prepare import above
from logscan.operators.quantile import exact_quantiles, grouped_quantiles

# Fixed values (as in the reference): the percentile that sets the anomaly
# threshold, those of the summary, the run metric names and the stage label.
THRESHOLD_PERCENTILE = 0.95
SUMMARY_PERCENTILES = (0.90, 0.95, 0.99)
METRIC_NAMES = ("total_logs", "anomalies_count", "anomalies_ratio", "duration_sec", "detect_sec")
DETECT_STAGE = "SparkProcess"


def mse_expr(a, b) -> Column:
    """A7 as a native expression: mean of squared differences of two arrays."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.aggregate(sq, F.lit(0.0), lambda s, v: s + v) / F.size(a)


def threshold(df: DataFrame, col: str = "recon_error", p: float = THRESHOLD_PERCENTILE,
              approx_accuracy: int | None = None):
    """A5: exact p-th percentile of the scores (None when empty).

    ``approx_accuracy`` opts into Spark's one-pass ``percentile_approx``
    (relative rank error 1/accuracy; it returns an observed value, not the
    interpolated one).
    """
    if approx_accuracy:
        return df.agg(F.percentile_approx(col, float(p), int(approx_accuracy)).alias("t")).first()["t"]
    res = exact_quantiles(df, col, [p])
    t = res[0][2][float(p)] if res else None
    if t is not None and math.isnan(t):
        raise ValueError("the percentile falls on scores that are not numbers")
    return t


def summarize(df: DataFrame, col: str = "recon_error", probs=SUMMARY_PERCENTILES, by=()) -> list:
    """Per group: dict with n, min_error, max_error, mean_error and the exact
    quantile of every p in ``probs`` (key p).  Count, min, max and sum ride
    on the first radix pass, so the scores are materialised once."""
    by = list(by)
    out = []
    for g, n, vals, info in exact_quantiles(df, col, probs, by=by, stats=True):
        row = {"group": g, "n": int(n), "min_error": info["min"], "max_error": info["max"],
               "mean_error": info["sum"] / n if n else None}
        row.update({float(p): vals.get(float(p)) for p in probs})
        out.append(row)
    if not out and not by:  # a global summary of nothing is one row, as in SQL
        out.append({"group": (), "n": 0, "min_error": None, "max_error": None, "mean_error": None,
                    **{float(p): None for p in probs}})
    return out


def summary_frame(spark, rows: list, probs=SUMMARY_PERCENTILES, by=(), by_types=()) -> DataFrame:
    """A4 rows as a DataFrame: [by...], n, min/max/mean_error, p90, p95, p99."""
    names = [f"p{round(p * 100)}" for p in probs]
    schema = ", ".join([f"{c} {t}" for c, t in zip(by, by_types)]
                       + ["n bigint", "min_error double", "max_error double", "mean_error double"]
                       + [f"{c} double" for c in names])
    data = [(*r["group"], r["n"], r["min_error"], r["max_error"], r["mean_error"],
             *[r[float(p)] for p in probs]) for r in rows]
    return spark.createDataFrame(data, schema)


def error_summary(df: DataFrame, col: str = "recon_error", probs=SUMMARY_PERCENTILES,
                  by=()) -> DataFrame:
    """A4: min, max, mean and exact percentiles, one row per group.

    Columns: [by...], n, min_error, max_error, mean_error, p90, p95, p99.
    """
    by = list(by)
    if not by:
        return summary_frame(df.sparkSession, summarize(df, col, probs), probs)
    return grouped_quantiles(df, col, probs, by).select(
        *by, "n", F.col("_min").alias("min_error"), F.col("_max").alias("max_error"),
        (F.col("_sum") / F.col("n")).alias("mean_error"),
        *[F.col(f"q{i}").alias(f"p{round(p * 100)}") for i, p in enumerate(probs)])


def run_counts(scored: DataFrame, thr, col: str = "recon_error") -> DataFrame:
    """A1-A3 in one pass: total_logs, anomalies_count, anomalies_ratio."""
    c = scored.agg(F.count(F.lit(1)).alias("total_logs"), F.count_if(above(col, thr)).alias("anomalies_count"))
    return c.withColumn(
        "anomalies_ratio",
        F.when(F.col("total_logs") > 0, F.col("anomalies_count") / F.col("total_logs"))
        .otherwise(F.lit(0.0)))


def metrics_long(counts: DataFrame, run_id, stage: str = DETECT_STAGE,
                 timings: dict | None = None, with_time: bool = True) -> DataFrame:
    """T5: run metrics in long form (one row per metric) via unpivot."""
    cols = {"total_logs": F.col("total_logs").cast("double"),
            "anomalies_count": F.col("anomalies_count").cast("double"),
            "anomalies_ratio": F.col("anomalies_ratio").cast("double")}
    for k, v in (timings or {}).items():
        cols[k] = F.lit(float(v))
    wide = counts.select(*[v.alias(k) for k, v in cols.items()])
    longf = wide.unpivot([], list(cols), "metric_name", "metric_value")
    rid = run_id if isinstance(run_id, Column) else F.lit(str(run_id))
    out = longf.select(rid.alias("run_id"), F.lit(stage).alias("stage"), "metric_name",
                       "metric_value")
    if with_time:
        out = out.select(F.current_timestamp().alias("event_time"), "*")
    return out


def epoch_history(errors: DataFrame, epoch_col: str = "epoch", col: str = "recon_error") -> DataFrame:
    """Per epoch the row-weighted mean error and its exact p90 / p95."""
    return (error_summary(errors, col, probs=(0.90, 0.95), by=[epoch_col])
            .select(epoch_col, "n", F.col("mean_error").alias("mean_loss"), "p90", "p95")
            .orderBy(epoch_col))
