"""Attach scores that arrive as a table to their log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logscan.schema import LOG_COLUMNS


def write_bucketed(df: DataFrame, table: str, key: str = "row_id", buckets: int = 64, location: str | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``, one file a bucket.

    Two tables with equal ``buckets`` join on the key without an exchange:
    the shuffle is paid once, when a table is written, not at each join.
    """
    w = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    (w.option("path", location) if location else w).saveAsTable(table)
    return df.sparkSession.table(table)


def attach_scores(logs: DataFrame, scores: DataFrame, key: str = "row_id") -> DataFrame:
    """Inner equi-join of log lines to ``(key, recon_error)``.

    Lines without a score (dropped before scoring) disappear.  The join
    strategy is left to Catalyst and AQE: a score table that turns out small
    at runtime is broadcast, otherwise both sides shuffle on the key, and
    AQE splits skewed key partitions; tables from ``write_bucketed`` join in
    place.  Output: key, log columns, TimeVal,
    recon_error.
    """
    joined = logs.join(scores.select(key, "recon_error"), key, "inner")
    cols = [key] + [c for c in LOG_COLUMNS + ["TimeVal"] if c in joined.columns] + ["recon_error"]
    return joined.select(*cols)
