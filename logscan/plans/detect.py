"""M6: detection as one lazy plan, and the batch run around it.

scan (declared schema) -> prepare / drop (native) -> text -> token slots
(native) -> reconstruction error (Arrow batches, broadcast model) -> strict
threshold filter -> sink.  No collect, no join, no shuffle on the default
path; counts for the run metrics are observed during the single write pass.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logscan.functions.hashing import EMBED_DIM, token_indices
from logscan.operators import prepare as P
from logscan.operators.score import Model, make_scorer
from logscan.operators.stats import DETECT_STAGE, metrics_long
from logscan.schema import METRIC_SCHEMA
from logscan.session import spread
from logscan.sources.logs import is_header_mismatch, read_logs
from logscan.sources.sinks import append_metrics, write_csv, write_metrics
from logscan.sources.staged import StagedResults


def featurize(lines: DataFrame, dim: int = EMBED_DIM, name: str = "slots") -> DataFrame:
    """M1: hashed token slots of every line's text (native expressions)."""
    return lines.withColumn(name, token_indices("text", dim))


def score_lines(logs: DataFrame, model: Model, with_time: bool = True, scorer=None,
                precision: str = "float64", input_partitions: int | None = None) -> DataFrame:
    """Prepared, complete lines with ``TimeVal``, ``text`` and ``recon_error``.

    ``scorer`` (from ``make_scorer``) reuses one model broadcast across calls.
    """
    if (model.meta or {}).get("features", "tokens") == "dense":
        raise ValueError("log lines are scored on token slots; this model expects dense features")
    dim = model.input_dim
    scorer = scorer or make_scorer(logs.sparkSession, model, kind="tokens", dim=dim, precision=precision)
    lines = featurize(P.scorable_lines(spread(logs, input_partitions), with_time=with_time), dim, "_slots")
    return lines.withColumn("recon_error", scorer("_slots")).drop("_slots")


def detect(logs: DataFrame, model: Model, threshold, with_row_id: bool = False) -> DataFrame:
    """Anomalous lines: log columns (masked Message), TimeVal, recon_error."""
    scored = score_lines(logs, model)
    if with_row_id:
        scored = P.with_row_id(scored)
    return P.result_columns(P.threshold_filter(scored, threshold), with_row_id=with_row_id)


def delete_inputs(spark: SparkSession, files, archive_dir: str | None = None, root: str = "") -> int:
    """T2 for batch runs: remove (or move to ``archive_dir``) exactly the
    files this run read; files that arrived later stay for the next run.
    Below the archive a file keeps its path relative to ``root``, so equal
    names in different folders do not collide; a move that fails raises.

    One metadata call per file from the driver, in line: right for a folder
    of uploads; for folders with very many files use the stream, whose
    ``cleanSource`` archives completed files in the background with a pool of
    threads (``spark.sql.streaming.fileSource.cleaner.numThreads``)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    base = jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/" if root else None
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        fs = path.getFileSystem(conf)
        if archive_dir:
            full = path.toUri().getPath()
            name = full[len(base):] if base and full.startswith(base) else full.lstrip("/")
            target = jvm.org.apache.hadoop.fs.Path(f"{archive_dir.rstrip('/')}/{name}")
            fs.mkdirs(target.getParent())
            ok = not fs.exists(target) and fs.rename(path, target)
        else:
            ok = fs.delete(path, False)
        if not ok:
            raise OSError(f"could not {'archive' if archive_dir else 'remove'} {f}; it would be read again")
        done += 1
    return done


def _score_and_write(spark, logs, model, threshold, dedupe, round_digits, with_row_id, precision, input_partitions,
                     write) -> dict:
    """Score log files, hand the anomalies to ``write`` and return the counts.
    The headers are checked by that one pass; files that differ are bound by
    header in a second one (a write that fails commits no file)."""

    def attempt(logs: DataFrame) -> dict:
        scored = score_lines(logs, model, precision=precision, input_partitions=input_partitions)
        if round_digits is not None:
            scored = scored.withColumn("recon_error", F.round("recon_error", round_digits))
        obs = Observation(f"run_{uuid.uuid4().hex}")
        scored = scored.observe(
            obs, F.count(F.lit(1)).alias("total_logs"),
            F.count_if(P.above("recon_error", threshold)).alias("anomalies_count"))
        if with_row_id:
            scored = P.with_row_id(scored)
        anomalies = P.result_columns(P.threshold_filter(scored, threshold), with_row_id=with_row_id)
        write(P.dedupe(anomalies) if dedupe else anomalies)
        return obs.get

    try:
        return attempt(logs)
    except Exception as e:  # noqa: BLE001
        if not is_header_mismatch(e):
            raise
        return attempt(read_logs(spark, logs.inputFiles(), headers="bind"))


def _metrics(total: int, anom: int, duration: float, detect: float) -> dict:
    return {"total_logs": float(total), "anomalies_count": float(anom),
            "anomalies_ratio": anom / total if total else 0.0, "duration_sec": duration, "detect_sec": detect}


def _store_metrics(spark, metrics: dict, run_id: str, table: str | None, path: str | None) -> None:
    cdf = spark.createDataFrame([(int(metrics["total_logs"]), int(metrics["anomalies_count"]), metrics["anomalies_ratio"])],
                                "total_logs bigint, anomalies_count bigint, anomalies_ratio double")
    rows = metrics_long(cdf, run_id, DETECT_STAGE, with_time=path is not None,
                        timings={k: metrics[k] for k in ("duration_sec", "detect_sec")})
    if table:
        append_metrics(rows, table)
    if path:
        write_metrics(rows, path)


def _has_metrics(spark, run_id: str, table: str | None, path: str | None) -> bool:
    """Whether a run's metrics are stored already (checked before they are
    written a second time by a run that starts again)."""
    if table:
        return not spark.table(table).where(F.col("run_id") == run_id).isEmpty()
    try:
        return not spark.read.schema(METRIC_SCHEMA).parquet(path).where(F.col("run_id") == run_id).isEmpty()
    except AnalysisException:
        return False  # nothing written yet


def _run_staged(spark, input_path, model, threshold, result_path, metrics_table, metrics_path, single_file, dedupe,
                consume, archive_dir, round_digits, with_row_id, precision, input_partitions, after_commit) -> dict:
    start = time.time()
    results = StagedResults(spark, result_path)
    root = input_path if isinstance(input_path, str) else ""

    def finish(manifest: dict) -> None:
        run_id = manifest["run_id"]
        for table, path in ((metrics_table, None), (None, metrics_path)):
            if (table or path) and manifest["metrics"] and not _has_metrics(spark, run_id, table, path):
                _store_metrics(spark, manifest["metrics"], run_id, table, path)
        if consume:
            delete_inputs(spark, results.still_there(manifest["inputs"]),
                          f"{archive_dir.rstrip('/')}/{run_id}" if archive_dir else None, root)
        results.finish(run_id)

    for manifest in results.unfinished():  # runs that died between their rows and their inputs
        finish(manifest)
    results.sweep()
    inputs = results.inputs(read_logs(spark, input_path, headers="scan").inputFiles())
    if not consume:  # inputs stay: leave out what committed runs have read
        read = {tuple(i) for r in results.committed() for i in results.manifest(r)["inputs"]}
        inputs = [i for i in inputs if tuple(i) not in read]
    if not inputs:
        return {"run_id": None, "status": "no_input"}
    run_id, t0 = results.run_id(inputs), time.perf_counter()
    logs = read_logs(spark, [f for f, *_ in inputs], headers="scan")
    counts = _score_and_write(spark, logs, model, threshold, dedupe, round_digits, with_row_id, precision, input_partitions,
                              lambda rows: results.write(run_id, rows, single_file))
    total = int(counts.get("total_logs", 0))
    metrics = _metrics(total, int(counts.get("anomalies_count", 0)), time.time() - start,
                       time.perf_counter() - t0) if total else {}
    results.commit(run_id, inputs, metrics)
    if after_commit:
        after_commit()
    finish({"run_id": run_id, "inputs": inputs, "metrics": metrics})
    return {"run_id": run_id, "status": "ok" if total else "no_rows", **metrics}


def run_batch(spark: SparkSession, input_path, model: Model, threshold: float, result_path: str,
              metrics_table: str | None = None, metrics_path: str | None = None,
              run_id: str | None = None, single_file: bool = False, dedupe: bool = False,
              consume: bool = False, archive_dir: str | None = None,
              round_digits: int | None = None, with_row_id: bool = False,
              precision: str = "float64", input_partitions: int | None = None, staged: bool = False,
              after_commit=None) -> dict:
    """One detection run over every file now in ``input_path``.

    Appends anomalies to ``result_path`` (CSV with header) and the five run
    metrics to a table or parquet folder.  Returns the metrics; a run with
    no input or no scorable line returns early without metrics.
    ``round_digits`` quantises scores before the comparison (ties);
    ``with_row_id`` puts a row key first in the output, as the serving job of
    the reference does (its values are unique per run, not across runs).
    ``staged`` keeps results in a ``StagedResults`` folder, where a run that was
    killed at any point and starts again leaves each row once; its run id is
    then that of its inputs.  ``after_commit`` is called once the rows are
    written, before metrics and inputs (fault injection in tests).
    """
    if staged:
        return _run_staged(spark, input_path, model, threshold, result_path, metrics_table, metrics_path, single_file,
                           dedupe, consume, archive_dir, round_digits, with_row_id, precision, input_partitions,
                           after_commit)
    run_id = run_id or str(uuid.uuid4())
    start = time.time()
    logs = read_logs(spark, input_path, headers="scan")
    files = logs.inputFiles()
    if not files:
        return {"run_id": run_id, "status": "no_input"}
    t0 = time.perf_counter()

    counts = _score_and_write(spark, logs, model, threshold, dedupe, round_digits, with_row_id, precision,
                              input_partitions,
                              lambda rows: write_csv(rows, result_path, mode="append", single_file=single_file))
    detect_sec = time.perf_counter() - t0
    total, anom = int(counts.get("total_logs", 0)), int(counts.get("anomalies_count", 0))
    if after_commit:
        after_commit()
    # Inputs go last: a run that fails before leaves them for the next one.
    root = input_path if isinstance(input_path, str) else ""
    archive = f"{archive_dir.rstrip('/')}/{run_id}" if archive_dir else None
    if total == 0:
        if consume:
            delete_inputs(spark, files, archive, root)
        return {"run_id": run_id, "status": "no_rows"}
    result = _metrics(total, anom, time.time() - start, detect_sec)
    _store_metrics(spark, result, run_id, metrics_table, metrics_path)
    if consume:
        delete_inputs(spark, files, archive, root)
    return {"run_id": run_id, "status": "ok", **result}
