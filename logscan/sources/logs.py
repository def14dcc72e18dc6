"""Log CSV sources, batch and streaming.

Columns are bound by the names in each file's header.  Files whose header is
the declared one (as nearly all are) need no header to be known before: the
executors compare each file's header with the schema while they read it
(``enforceSchema=false``).  Only after a mismatch one job reads the first line
of every file, and the files are read by header, one scan per distinct one.
"""

from __future__ import annotations

import csv
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.schema import LOG_SCHEMA

# Text layout of the Timestamp column on write (microseconds, no zone).
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
# How Spark reports a file whose header is not the schema's.
HEADER_MISMATCH = ("CSV header does not conform to the schema",
                   "Number of column in CSV header is not equal to number of fields in the schema")
WHOLE_FILE = str(1 << 50)  # split size at which every file is one partition


def _reader(reader, schema):
    # No timestampFormat on read: Spark's default parser takes 'T' or a space,
    # any fraction up to microseconds and an optional offset.
    return reader.schema(schema).option("header", True).option("mode", "PERMISSIVE")


def _declared(spark: SparkSession, path, schema) -> DataFrame:
    """Files read by the declared schema, each header checked on its executor;
    the first header cell of a log is blank where the schema says ``_c0``."""
    cells = T.StructType([T.StructField("" if f.name == "_c0" else f.name, f.dataType) for f in schema.fields])
    return _reader(spark.read, cells).option("enforceSchema", False).csv(path).toDF(*schema.names)


def is_header_mismatch(error: Exception) -> bool:
    return any(text in str(error) for text in HEADER_MISMATCH)


def _probe_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which a file is one partition, so
    that a job can look at the start of every file and stop there."""
    sc = spark.sparkContext
    if getattr(sc, "_logscan_probe", None) is None:
        probe = spark.newSession()
        for k, v in {"spark.sql.files.maxPartitionBytes": WHOLE_FILE, "spark.sql.files.openCostInBytes": WHOLE_FILE,
                     "spark.sql.csv.parser.columnPruning.enabled": "false",
                     "spark.sql.adaptive.enabled": "false"}.items():
            probe.conf.set(k, v)
        sc._logscan_probe = probe
    return sc._logscan_probe


def headers_match(spark: SparkSession, path, schema=LOG_SCHEMA) -> bool:
    """One job, a task per file: the limit under the aggregate stops each task
    after its file's header and first row."""
    first = _declared(_probe_session(spark), path, schema).limit(1)
    try:
        first.agg(F.max(F.struct(*first.columns))).collect()
    except Exception as e:  # noqa: BLE001 - only a header mismatch is an answer
        if is_header_mismatch(e):
            return False
        raise
    return True


def _first_lines(batches):
    """The first line that is not blank; the rest of the file is not read."""
    for batch in batches:
        for value, file in zip(batch.column("value").to_pylist(), batch.column("file").to_pylist()):
            if value.strip():
                yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([file])], ["value", "file"])
                return


def file_headers(spark: SparkSession, path) -> dict[tuple, list]:
    """{header cells: files}; one job, a task per file that reads its first
    batch of lines only.  Files without a line are left out."""
    lines = (_probe_session(spark).read.text(path).select("value", F.input_file_name().alias("file"))
             .mapInArrow(_first_lines, "value string, file string"))
    out: dict[tuple, list] = {}
    for line, file in lines.collect():
        out.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    return out


def _bound(spark: SparkSession, files, header: tuple, schema) -> DataFrame:
    """Files of one header, read by name (the first cell of that name, in any
    case) with the declared types."""
    cells = [f"_c{i}" if not c else c.lower() for i, c in enumerate(header)]
    missing = [c for c in schema.names if c != "_c0" and c.lower() not in cells]
    if missing:
        raise ValueError(f"columns {missing} are missing in {files[0]}")
    at = {f.name: cells.index(f.name.lower()) for f in schema.fields if f.name.lower() in cells}
    kinds = {i: schema[name].dataType for name, i in at.items()}
    own = T.StructType([T.StructField(f"c{i}", kinds.get(i, T.StringType())) for i in range(len(cells))])
    df = _reader(spark.read, own).csv(list(files))
    return df.select(*[F.col(f"c{at[f.name]}").alias(f.name) if f.name in at else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def read_logs(spark: SparkSession, path, schema=LOG_SCHEMA, headers: str = "check") -> DataFrame:
    """S1 + S2: one file, a folder or a list of them, with declared types.

    Files may lack the index column or order their columns differently, also
    within one folder.  A missing log column raises.  A single path that does
    not exist gives an empty DataFrame (the run ends quietly); a missing path
    in a list raises.

    ``headers`` says when headers are compared: ``check`` in one job over the
    files' first rows, now; ``scan`` only while the returned frame is read,
    which fails if a file differs (``is_header_mismatch``: read again with
    ``bind``); ``bind`` reads every file's header now and binds by it.
    """
    if headers not in ("check", "scan", "bind"):
        raise ValueError(f"headers: {headers}")
    try:
        declared = _declared(spark, path, schema)
        files = declared.inputFiles()
    except AnalysisException as e:
        cond = e.getCondition() if hasattr(e, "getCondition") else None
        absent = cond == "PATH_NOT_FOUND" or "Path does not exist" in str(e)
        if absent and (isinstance(path, str) or len(path) == 1):
            return spark.createDataFrame([], schema)
        raise
    if not files:
        return spark.createDataFrame([], schema)
    if headers == "scan" or (headers == "check" and headers_match(spark, path, schema)):
        return declared
    groups = file_headers(spark, path)
    if not groups:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [_bound(spark, fs, h, schema) for h, fs in groups.items()])


def stream_logs(spark: SparkSession, folder: str, schema=LOG_SCHEMA, archive_dir: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: every CSV that lands in ``folder``, each read once.

    Progress lives in the query checkpoint; with ``archive_dir`` processed
    files are moved there (the reference deletes them), so the folder only
    holds unread files.  A stream binds columns by position: all landed files
    must have the declared columns in the declared order (``read_logs`` binds
    by name).
    """
    r = _reader(spark.readStream, schema)
    if archive_dir and archive_dir.rstrip("/").startswith(folder.rstrip("/") + "/"):
        raise ValueError("the archive folder must lie outside the watched folder")
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.csv(folder)
