"""Anomaly CSV sink and the run-metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscan.sources.logs import TIMESTAMP_FORMAT

METRIC_TABLE = "logs.metrics"


def write_csv(df: DataFrame, path: str, mode: str = "append", single_file: bool = False) -> None:
    """S6 (append) / S7 (overwrite): header, microsecond timestamps.

    ``single_file`` funnels the output through one task as the reference
    does; it is off by default so the last stage stays parallel.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", True).option("timestampFormat", TIMESTAMP_FORMAT)
     .csv(path))


def create_metric_table(spark: SparkSession, table: str = METRIC_TABLE, location: str | None = None,
                        database_location: str | None = None) -> None:
    """Create the metric table (and its database) when absent.

    ``location`` makes the table external at that folder; a new database
    is placed at ``database_location`` (default: the session's warehouse).
    """
    if "." in table:
        db_loc = f" LOCATION '{database_location}'" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}{db_loc}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} (
        event_time TIMESTAMP DEFAULT current_timestamp(),
        run_id STRING, stage STRING, metric_name STRING, metric_value DOUBLE
    ) USING parquet{loc}""")


def truncate_metric_table(spark: SparkSession, table: str = METRIC_TABLE) -> None:
    """Empty the table; external tables (with LOCATION) refuse TRUNCATE, so
    they are overwritten with an empty selection instead."""
    from pyspark.errors import AnalysisException

    try:
        spark.sql(f"TRUNCATE TABLE {table}")
    except AnalysisException as e:
        if "external" not in str(e).lower():
            raise
        empty = spark.createDataFrame([], spark.table(table).schema)
        empty.write.mode("overwrite").insertInto(table)


def append_metrics(metrics: DataFrame, table: str = METRIC_TABLE) -> None:
    """All metrics of a run in one insert; event_time from the default
    unless the frame carries it.  Rows are ordered by (event_time, run_id)
    within each file, the table's sort order."""
    spark = metrics.sparkSession
    view = f"_metrics_{abs(hash((table, id(metrics)))) % 10**9}"
    metrics.sortWithinPartitions(*[c for c in ("event_time", "run_id") if c in metrics.columns]) \
        .createOrReplaceTempView(view)
    cols = [c for c in ("event_time", "run_id", "stage", "metric_name", "metric_value")
            if c in metrics.columns]
    spark.sql(f"INSERT INTO {table} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {view}")
    spark.catalog.dropTempView(view)


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """S8 for a path-based store (parquet folder) instead of a table."""
    metrics.sortWithinPartitions("run_id").write.mode(mode).parquet(path)
