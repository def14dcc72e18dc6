"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every logscan job relies on.  UTC keeps timestamp text and epoch
# conversions identical to the SQL oracle; AQE re-plans joins and coalesces
# small shuffle partitions at runtime; Arrow moves model batches to Python.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Runtime SQL settings that only change speed, never results.  The line rules
# are wide expressions; a fused stage above HotSpot's 8,000-byte limit would
# not be JIT-compiled, so such stages fall back to per-operator code instead
# (3-5x faster per row on a million lines here).
SQL_TUNING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply SQL_TUNING to a session created elsewhere (e.g. by a driver)."""
    for k, v in SQL_TUNING.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str = "local[*]", app: str = "logscan", shuffle_partitions: int = 8,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf.update(SQL_TUNING)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)  # the configured shared folder, or a private one only when unset
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint location of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); it is read from the session and used as is.  Only when it is unset,
    as in local tests, a private folder is made and registered, so later calls
    in the same session agree on it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)  # named after start-up: register it
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # Unset, in an ad-hoc local session: driver and executors are one process.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logscan-ckpt-"))
        base = spark.sparkContext.getCheckpointDir()
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique folder below the work folder (one per run)."""
    return work_dir(spark, kind, uuid.uuid4().hex)


def _package_zip() -> bytes:
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, root))
    return buf.getvalue()


def ship_package(spark: SparkSession, shared: bool | None = None) -> None:
    """Make ``logscan`` importable in executor Python workers.

    Arrow batch functions refer to functions of this package, so workers
    must import it.  The package is zipped once per SparkContext and added
    with ``addPyFile``.  In local mode the zip is a private temporary file;
    on a cluster it is written to the shared work folder first (no
    machine-local folder), from where every executor fetches it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_logscan_shipped", False):
        return
    data = _package_zip()
    if shared is None:
        shared = not sc.master.startswith("local")
    if shared:
        path = work_dir(spark, "pyfiles", f"logscan-{uuid.uuid4().hex}.zip")
        jvm = sc._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    else:
        fd, path = tempfile.mkstemp(prefix="logscan-", suffix=".zip")
        with os.fdopen(fd, "wb") as f:
            f.write(data)
    sc.addPyFile(path)
    sc._logscan_shipped = True


def spread(df, partitions: int | None = None):
    """The input dealt round-robin over ``partitions`` tasks when a number is
    given, else as it is.

    For a job whose input is one unsplittable file but whose work per row is
    heavy (token hashing, model batches).  It is the caller's choice: layout,
    row ids and random splits must not change with the size of the input.
    """
    return df.repartition(int(partitions)) if partitions else df


def input_partitions(spark: SparkSession) -> int | None:
    """``spark.logscan.inputPartitions``, the session's choice for ``spread``."""
    n = spark.conf.get("spark.logscan.inputPartitions", None)
    return int(n) if n else None
