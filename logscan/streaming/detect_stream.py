"""Detection over a folder that keeps receiving log CSVs.

Each micro-batch writes its anomalies and its run metrics into folders
partitioned by ``batch_id`` with dynamic partition overwrite, so a batch
that is replayed after a failure replaces its own output instead of adding
rows twice.  The run id is ``{query id}-{batch id}``, stable on replay.

Counts are observed while a batch is scored and written with it; its two
durations are only known once it is over, so they come from the query's
progress events and go to a partition beside the counts.  With a model store
as the model, every batch asks for the current version and loads it if it has
changed since the batch before.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from logscan.operators import prepare as P
from logscan.operators.score import Model, make_scorer
from logscan.operators.stats import DETECT_STAGE
from logscan.plans.detect import score_lines
from logscan.sources.file_events import stream_file_events, with_log_lines
from logscan.sources.logs import TIMESTAMP_FORMAT, stream_logs
from logscan.sources.model_store import current_version, load_model

# Fixed value (as in the reference): poll interval of the scheduled run.
DEFAULT_TRIGGER = "3 minutes"


def _write_partition(df: DataFrame, path: str, fmt: str, keys=("batch_id",)) -> None:
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys))
    if fmt == "csv":
        w.option("header", True).option("timestampFormat", TIMESTAMP_FORMAT).csv(path)
    else:
        w.format(fmt).save(path)


def _write_metrics(spark: SparkSession, values: dict, run_id: str, batch_id: int, part: str, path: str) -> None:
    """Metrics of one batch; ``part`` keeps counts and durations from replacing
    each other."""
    rows = spark.createDataFrame([tuple(float(v) for v in values.values())], [*values])
    rows = rows.unpivot([], [*values], "metric_name", "metric_value")
    _write_partition(rows.select(F.current_timestamp().alias("event_time"), F.lit(run_id).alias("run_id"),
                                 F.lit(DETECT_STAGE).alias("stage"), "metric_name", "metric_value",
                                 F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(part).alias("part")),
                     path, "parquet", ("batch_id", "part"))


class LoadedModel:
    """The model and threshold of a batch: fixed ones, or those of a store's
    current version, loaded again whenever it names another one."""

    def __init__(self, model: Model | str, threshold: float | None = None):
        self.path = model if isinstance(model, str) else None
        self.fixed = None if threshold is None else float(threshold)  # overrides the stored ones
        self.model, self.threshold = (None, None) if self.path else (model, self.fixed)
        self.version, self.scorer = None, None

    def at_batch(self, spark: SparkSession) -> "LoadedModel":
        if self.path:
            version = current_version(spark, self.path)
            if self.scorer is None or version != self.version:
                self.model, stored = load_model(spark, self.path, version)
                self.threshold = stored if self.fixed is None else self.fixed
                self.version, self.scorer = version, None
        if self.threshold is None:
            raise ValueError("the model has no threshold")
        if self.scorer is None:
            self.scorer = make_scorer(spark, self.model, kind="tokens", dim=self.model.input_dim)
        return self


class DurationListener(StreamingQueryListener):
    """``duration_sec`` (the whole trigger) and ``detect_sec`` (scoring and
    writing) of every batch that wrote counts, from the progress events of one
    query."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.run, self.counted, self.stored = None, set(), set()
        self.early, self.lock = [], threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names of the interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run:
            self.spark.streams.removeListener(self)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = json.loads(event.progress.json)
        with self.lock:
            if self.run is None:  # started, but not yet known here
                self.early.append(progress)
                return
        self.store([progress])

    def attach(self, query: StreamingQuery) -> None:
        with self.lock:
            self.run = str(query.runId)
            early, self.early = self.early, []
        self.store(early)

    def store(self, progresses) -> None:
        with self.lock:
            for p in progresses:
                batch, ms = p["batchId"], p["durationMs"]
                if p["runId"] != self.run or batch not in self.counted or batch in self.stored or "addBatch" not in ms:
                    continue
                _write_metrics(self.spark, {"duration_sec": ms["triggerExecution"] / 1000.0,
                                            "detect_sec": ms["addBatch"] / 1000.0},
                               f"{p['id']}-{batch}", batch, "durations", self.path)
                self.stored.add(batch)


_LISTENERS: dict[str, DurationListener] = {}


def finish_metrics(query: StreamingQuery, timeout: float = 30.0) -> None:
    """Wait until the durations of every counted batch of a stopped query are
    stored (its last event may still be on its way)."""
    listener = _LISTENERS.pop(str(query.runId), None)
    if listener is None:
        return
    end = time.time() + timeout
    while listener.counted - listener.stored and time.time() < end:
        listener.store([json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress])
        time.sleep(0.05)


def batch_writer(model: Model | str, threshold: float | None, result_path: str, metrics_path: str | None,
                 fmt: str = "csv", round_digits: int | None = None, input_partitions: int | None = None,
                 counted: set | None = None):
    """foreachBatch function: score one micro-batch of log lines and write
    its anomalies and counts (T3).

    Scoring happens here, on the micro-batch as a batch DataFrame; one model
    broadcast serves every batch until the model changes.  ``model`` is a model
    or the path of a model store; ``input_partitions`` deals a batch over that
    many tasks (a batch of one file is one split).  Numbers of the batches that
    wrote counts are added to ``counted``.
    """
    loaded = LoadedModel(model, threshold)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = loaded.at_batch(spark)
        qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        scored = score_lines(batch, now.model, scorer=now.scorer, input_partitions=input_partitions)
        if round_digits is not None:
            scored = scored.withColumn("recon_error", F.round("recon_error", round_digits))
        obs = Observation(f"batch_{batch_id}")
        scored = scored.observe(obs, F.count(F.lit(1)).alias("total_logs"),
                                F.count_if(P.above("recon_error", now.threshold)).alias("anomalies_count"))
        anomalies = P.result_columns(P.threshold_filter(scored, now.threshold)).withColumn(
            "batch_id", F.lit(batch_id))
        _write_partition(anomalies, result_path, fmt)
        counts = obs.get
        total = int(counts.get("total_logs", 0))
        if total == 0 or not metrics_path:
            return  # empty batches leave no metrics (T6 / detail 11)
        anom = int(counts.get("anomalies_count", 0))
        _write_metrics(spark, {"total_logs": total, "anomalies_count": anom, "anomalies_ratio": anom / total},
                       f"{qid}-{batch_id}", batch_id, "counts", metrics_path)
        if counted is not None:
            counted.add(batch_id)

    return write


def start_detect_stream(spark: SparkSession, source: DataFrame | str, model: Model | str, threshold: float | None,
                        result_path: str, checkpoint: str, metrics_path: str | None = None,
                        trigger: str | None = DEFAULT_TRIGGER, available_now: bool = False,
                        archive_dir: str | None = None, fmt: str = "csv",
                        round_digits: int | None = None, query_name: str | None = None,
                        dedupe_within: str | None = None,
                        max_files_per_trigger: int | None = None,
                        input_partitions: int | None = None, file_events: bool = False) -> StreamingQuery:
    """Start the detection stream.

    ``source`` is a folder of log CSVs (S3) or any streaming DataFrame of
    log lines.  Repeated lines are scored again, as in the reference (T6);
    ``dedupe_within`` (e.g. ``'1 hour'``) drops a line seen again within that
    event-time delay instead (watermark on ``Timestamp``, bounded state).
    ``max_files_per_trigger`` bounds a micro-batch when a backlog has built up;
    ``input_partitions`` deals each one over that many tasks.  With
    ``file_events`` the folder is watched by path, modification time and length
    (a replaced file is read again) and its files are bound by header; each
    batch then takes all files that have landed.
    ``available_now`` processes what is there and stops (for an external
    scheduler, T1); otherwise it polls every ``trigger``.

    ``model`` may be the path of a model store: a version that becomes current
    while the stream runs is used from the next batch on, with its threshold
    (unless ``threshold`` overrides it).  With ``metrics_path`` every batch
    leaves five metrics; call ``finish_metrics`` after the query has stopped,
    so that the last durations are stored too.
    """
    if file_events:
        if dedupe_within or max_files_per_trigger or not isinstance(source, str):
            raise ValueError("file_events watches a folder, without dedupe_within or max_files_per_trigger")
        logs = stream_file_events(spark, source, archive_dir)
    elif isinstance(source, str):
        logs = stream_logs(spark, source, archive_dir=archive_dir, max_files_per_trigger=max_files_per_trigger)
    else:
        logs = source
    if dedupe_within:
        logs = (logs.withWatermark("Timestamp", dedupe_within)
                .dropDuplicatesWithinWatermark([c for c in logs.columns if c != "_c0"]))
    listener = DurationListener(spark, metrics_path) if metrics_path else None
    if listener:
        spark.streams.addListener(listener)
    write = batch_writer(model, threshold, result_path, metrics_path, fmt, round_digits, input_partitions,
                         listener.counted if listener else None)
    w = (logs.writeStream.foreachBatch(with_log_lines(write) if file_events else write)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    query = w.start()
    if listener:
        listener.attach(query)
        _LISTENERS[str(query.runId)] = listener
    return query
