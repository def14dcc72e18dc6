"""The driver's ``events`` table viewed as log lines.

The adapter is plain column arithmetic, so the same view is written in SQL
for the oracle (``logscan.plans.oracles``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_logs(events: DataFrame, *keep: str) -> DataFrame:
    """One log line per event, in the layout of a log CSV (plus ``keep``)."""
    uid = F.col("user_id")
    return events.select(
        *keep,
        F.col("event_id").alias("_c0"),
        F.col("ts").cast("timestamp").alias("Timestamp"),
        F.upper("event_type").alias("LogLevel"),
        F.concat(F.lit("Service"), F.chr(F.lit(65) + uid % 4)).alias("Service"),
        F.concat(F.lit("evt "), F.col("event_type"), F.lit(" by User"), uid.cast("string"),
                 F.lit(" from 10.0."), (uid % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")).alias("Message"),
        F.col("event_id").alias("RequestID"),
        F.concat(F.lit("User"), uid.cast("string")).alias("User"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."),
                 (F.col("event_id") % 256).cast("string")).alias("ClientIP"),
        F.concat(F.col("value").cast("string"), F.lit("ms")).alias("TimeTaken"),
    )


def events_as_dirty_logs(events: DataFrame) -> DataFrame:
    """The log view with gaps derived from each event's ``props.k`` value.

    Every row is kept; k mod 10 decides the defect: 0 -> TimeTaken ``nanms``,
    1 -> no LogLevel, 2 -> no Message, 3 -> unreadable TimeTaken, 4 -> no
    Service, 5 -> no TimeTaken.  It exercises the drop rules on real volume.
    """
    k = F.get_json_object("props", "$.k").try_cast("bigint") % 10
    logs = events_as_logs(events.withColumn("_k", k), "_k")
    return logs.select(
        "_c0", "Timestamp",
        F.when(F.col("_k") == 1, F.lit(None)).otherwise(F.col("LogLevel")).alias("LogLevel"),
        F.when(F.col("_k") == 4, F.lit(None)).otherwise(F.col("Service")).alias("Service"),
        F.when(F.col("_k") == 2, F.lit(None)).otherwise(F.col("Message")).alias("Message"),
        "RequestID", "User", "ClientIP",
        F.when(F.col("_k") == 0, F.lit("nanms"))
        .when(F.col("_k") == 3, F.concat(F.col("TimeTaken"), F.lit("x")))
        .when(F.col("_k") == 5, F.lit(None))
        .otherwise(F.col("TimeTaken")).alias("TimeTaken"),
    )
