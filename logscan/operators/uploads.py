"""Upload events: decode (U1), object key (U2), current file per name (U3),
event time stamp (U4), and the JSON encoding that publishes them (S5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscan.schema import EVENT_DDL

# Fixed value (as in the reference): folder prefix of landed files.
UPLOAD_PREFIX = "uploads/"


def encode_event(df: DataFrame) -> DataFrame:
    """One JSON ``value`` per event, no key."""
    return df.select(F.to_json(F.struct("filePath", "fileName", "uploadTime")).alias("value"))


def decode_event(df: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """JSON value -> filePath, fileName, uploadTime, upload_ts, is_valid
    (plus the input columns named in ``keep``).

    Malformed or incomplete events are kept with ``is_valid = false`` so a
    caller can route them to a reject output instead of losing them.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), EVENT_DDL)
    keep = list(keep)
    out = df.select(*keep, parsed.alias("_e"))
    return out.select(
        *keep,
        F.col("_e.filePath").alias("filePath"),
        F.col("_e.fileName").alias("fileName"),
        F.col("_e.uploadTime").alias("uploadTime"),
        F.timestamp_millis(F.col("_e.uploadTime")).alias("upload_ts"),
        (F.col("_e.filePath").isNotNull() & F.col("_e.fileName").isNotNull()
         & F.col("_e.uploadTime").isNotNull()).alias("is_valid"),
    )


def object_key(file_path) -> Column:
    """``uploads/`` + last element of the path (either separator)."""
    p = F.col(file_path) if isinstance(file_path, str) else file_path
    return F.concat(F.lit(UPLOAD_PREFIX), F.regexp_extract(p, r"([^/\\]*)$", 1))


def landing_key(file_name, upload_time) -> Column:
    """A unique landing name ``uploads/{uploadTime}-{name}``; a file source
    never re-reads a name it has seen, so reused names must not collide."""
    n = F.col(file_name) if isinstance(file_name, str) else file_name
    t = F.col(upload_time) if isinstance(upload_time, str) else upload_time
    return F.concat(F.lit(UPLOAD_PREFIX), t.cast("string"), F.lit("-"), n)


def stamp_now() -> Column:
    """U4: upload time as epoch milliseconds now."""
    return F.unix_millis(F.current_timestamp())


def upload_events_for(paths: DataFrame, path_col: str = "filePath") -> DataFrame:
    """U4 + the event an upload produces: for every stored file path, the
    file name (last path element, either separator) and the upload time as
    epoch milliseconds now; ready for ``encode_event`` / publishing."""
    p = F.col(path_col)
    return paths.select(p.alias("filePath"), F.regexp_extract(p, r"([^/\\]*)$", 1).alias("fileName"),
                        stamp_now().alias("uploadTime"))


def latest_uploads(events: DataFrame, name: str = "fileName", time: str = "uploadTime",
                   tie: str = "filePath") -> DataFrame:
    """The current file of every name: the latest upload wins, ties go to
    the greatest path.

    A grouped max over a struct: partial aggregation keeps one candidate per
    name and partition before the shuffle, so a name that holds a third of
    all events costs no more than any other (a window would sort that whole
    group in one task).
    """
    others = [c for c in events.columns if c not in (name, time, tie)]
    best = F.max(F.struct(F.col(time), F.col(tie), *[F.col(c) for c in others])).alias("_b")
    return (events.where(F.col(name).isNotNull() & F.col(time).isNotNull())
            .groupBy(name).agg(best)
            .select(name, *[F.col(f"_b.{c}").alias(c) for c in [time, tie, *others]]))
