"""Row-wise preparation of log lines: projections, keys, drops, text.

Everything here is a narrow transformation (no shuffle) except ``dedupe``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscan.functions.text import compose_text, mask_message, parse_time, time_is_nan
from logscan.schema import LOG_COLUMNS, SCORED_COLUMNS


def drop_index(df: DataFrame) -> DataFrame:
    """Drop the unnamed index column when present."""
    return df.drop("_c0")


def prepare(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    """P1 + P2 + F1-F3: masked ``Message`` and float32 ``TimeVal``.

    ``keep_raw`` keeps the unmasked message as ``RawMessage``.
    """
    df = drop_index(df)
    cols = {"Message": mask_message("Message"), "TimeVal": parse_time("TimeTaken")}
    if keep_raw:
        df = df.withColumn("RawMessage", F.col("Message"))
    return df.withColumns(cols)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """P5: a 64-bit id, unique within one plan (not consecutive)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop lines where a scored column is null or NaN."""
    return df.na.drop(how="any", subset=list(subset or SCORED_COLUMNS))


def drop_incomplete_raw(df: DataFrame) -> DataFrame:
    """P4 stated on the raw log columns, for lines that ``prepare`` follows.

    After preparation a Message is never null (it becomes the text None) and
    TimeVal is never null and is NaN exactly when TimeTaken reads as NaN, so
    the rule is: LogLevel and Service present and TimeTaken not a NaN.  The
    null tests reach the scan as pushed filters and no masking or parsing
    runs for the test itself.
    """
    return df.where(F.col("LogLevel").isNotNull() & F.col("Service").isNotNull()
                    & ~time_is_nan("TimeTaken"))


def with_text(df: DataFrame, with_time: bool = True, name: str = "text") -> DataFrame:
    """F4 + F5: the model input text of every line."""
    return df.withColumn(
        name, compose_text("LogLevel", "Service", "Message", "TimeVal" if with_time else None))


def scorable_lines(df: DataFrame, with_time: bool = True) -> DataFrame:
    """Prepared, complete lines with their text; log columns kept."""
    return with_text(prepare(drop_incomplete_raw(df)), with_time=with_time)


def above(col: str, threshold) -> Column:
    """Whether an error is strictly above the threshold; a NaN error is not
    (Spark would order it above every number)."""
    if not isinstance(threshold, Column):
        if math.isnan(float(threshold)):
            raise ValueError("the threshold is not a number")
        threshold = F.lit(float(threshold))
    return (F.col(col) > threshold) & ~F.isnan(col)


def threshold_filter(df: DataFrame, threshold, col: str = "recon_error") -> DataFrame:
    """Lines whose error is strictly above the threshold.

    ``threshold`` is a number or a one-row DataFrame with a ``threshold``
    column; the latter becomes a scalar subquery (evaluated once, used as a
    value; more than one row is an error), so nothing is joined or collected.
    """
    if isinstance(threshold, DataFrame):
        return df.filter(above(col, threshold.select("threshold").scalar()))
    return df.filter(above(col, threshold))


def dedupe(df: DataFrame, on=None) -> DataFrame:
    """Full-row distinct by default; ``on`` dedupes by those columns."""
    return df.distinct() if on is None else df.dropDuplicates(list(on))


def top_k(df: DataFrame, k: int = 10, order_by: str = "recon_error", tie_break=None) -> DataFrame:
    """P7 as a top-k: per-partition top-k then one bounded merge
    (TakeOrderedAndProject), never a full sort."""
    keys = [F.col(order_by).desc()] + [F.col(c).asc() for c in (tie_break or [])]
    return df.orderBy(*keys).limit(k)


def preview(df: DataFrame, n: int = 10) -> None:
    """P7 as the reference does it: print n rows untruncated."""
    df.show(n, truncate=False)


def schema_report(df: DataFrame) -> str:
    """The schema tree as text (also printed)."""
    text = df.schema.treeString()
    print(text)
    return text


def result_columns(df: DataFrame, with_row_id: bool = False) -> DataFrame:
    """Explicit column order of a result: log columns, TimeVal, error."""
    cols = (["row_id"] if with_row_id else []) + LOG_COLUMNS + ["TimeVal", "recon_error"]
    return df.select(*[c for c in cols if c in df.columns])
