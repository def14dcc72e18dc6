"""Declared schemas.  Declaring them saves the inference scan, keeps types
stable from file to file and is required by streaming file sources."""

from pyspark.sql import types as T

# A log CSV: first header cell is blank, so Spark calls that column _c0.
LOG_SCHEMA = T.StructType([
    T.StructField("_c0", T.LongType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("LogLevel", T.StringType()),
    T.StructField("Service", T.StringType()),
    T.StructField("Message", T.StringType()),
    T.StructField("RequestID", T.LongType()),
    T.StructField("User", T.StringType()),
    T.StructField("ClientIP", T.StringType()),
    T.StructField("TimeTaken", T.StringType()),
])

LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields if f.name != "_c0"]

# Columns whose null (or NaN) value makes a line unscorable.
SCORED_COLUMNS = ["LogLevel", "Service", "Message", "TimeVal"]

# Upload event as published on the topic (epoch milliseconds).
EVENT_SCHEMA = T.StructType([
    T.StructField("filePath", T.StringType()),
    T.StructField("fileName", T.StringType()),
    T.StructField("uploadTime", T.LongType()),
])
EVENT_DDL = "filePath STRING, fileName STRING, uploadTime BIGINT"

# Run metrics in long form, one row per metric.
METRIC_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
])

# Model parameters, one row per dense layer: y = act(x @ w + b),
# w stored row-major with shape (rows, cols).
LAYER_SCHEMA = T.StructType([
    T.StructField("layer", T.IntegerType(), False),
    T.StructField("rows", T.IntegerType(), False),
    T.StructField("cols", T.IntegerType(), False),
    T.StructField("w", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("b", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("act", T.StringType(), False),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("recon_error", T.DoubleType()),
])
