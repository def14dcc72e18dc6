"""Driver queries over the test tables (their DuckDB oracles: ``oracles.py``).

Every query reads whole tables (no id subsets, no row caps).  The ``events``
table stands in for log lines through a column-arithmetic view, written as
DataFrame code in ``sources.events`` and as SQL in ``oracles.py``.
Computed doubles are rounded to 9 places in both forms so that summation
order cannot change a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscan.functions.hashing import EMBED_DIM, split_label, token_indices
from logscan.functions.text import mask_message, parse_time
from logscan.operators import prepare as P
from logscan.operators.join import attach_scores
from logscan.operators.quantile import exact_quantiles
from logscan.operators.score import rank_one_model, recon_error
from logscan.operators.stats import error_summary, metrics_long, run_counts, threshold
from logscan.operators.uploads import decode_event, latest_uploads, object_key
from logscan.session import fresh_dir, input_partitions, spread, work_dir
from logscan.sources.events import events_as_dirty_logs, events_as_logs, read_table

DIGITS = 9  # rounding of computed doubles in query outputs
TIE_DIGITS = 12  # quantisation of log-line errors before thresholding


def fixed_weight(d: int) -> float:
    """Closed-form weights of the reference-free test model."""
    return ((d * 7) % 11 - 5) / 40.0


def _r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


# ------------------------------------------------------------ Spark helpers
def logs_view(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    ev = spread(read_table(spark, sf_dir, "events"), input_partitions(spark))
    return events_as_dirty_logs(ev) if dirty else events_as_logs(ev)


def embedding_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rank_one_model(64, fixed_weight)
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", recon_error(spark, model, "embedding").alias("recon_error"))


def log_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 chain on events-as-logs with the rank-1 model over token slots."""
    lines = P.scorable_lines(logs_view(spark, sf_dir))
    model = rank_one_model(EMBED_DIM, fixed_weight)
    return (lines.withColumn("slots", token_indices("text"))
            .withColumn("recon_error", recon_error(spark, model, "slots", kind="tokens"))
            .drop("slots"))


# ------------------------------------------------------------------ queries
def q_mask_message(spark, sf_dir):
    return logs_view(spark, sf_dir).select(F.col("_c0").alias("event_id"),
                                           mask_message("Message").alias("Message"))


def q_mask_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", mask_message("text").alias("masked"))


def q_parse_time(spark, sf_dir):
    t = parse_time("TimeTaken")
    return logs_view(spark, sf_dir, dirty=True).select(
        F.col("_c0").alias("event_id"), "TimeTaken",
        F.when(F.isnan(t), F.lit(None)).otherwise(t).alias("TimeVal"),
        F.isnan(t).alias("time_is_nan"))


def q_compose_text(spark, sf_dir):
    prepared = P.prepare(logs_view(spark, sf_dir).withColumn("event_id", F.col("_c0")))
    return P.with_text(prepared).select("event_id", "text")


def q_drop_incomplete(spark, sf_dir):
    dirty = logs_view(spark, sf_dir, dirty=True).withColumn("event_id", F.col("_c0"))
    return P.drop_incomplete(P.prepare(dirty)).select(
        "event_id", "LogLevel", "Service", "Message", "TimeVal")


def q_split_bucket(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", split_label("event_id").alias("split"))


def q_token_index(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents"), input_partitions(spark))
    return (docs.select("doc_id", F.explode(token_indices("text")).alias("idx"))
            .groupBy("doc_id", "idx").agg(F.count(F.lit(1)).alias("n")))


def q_recon_error_fixed(spark, sf_dir):
    return embedding_errors(spark, sf_dir).select("vec_id", _r("recon_error").alias("recon_error"))


def q_threshold(spark, sf_dir):
    errs = embedding_errors(spark, sf_dir)
    (_, n, vals), = exact_quantiles(errs, "recon_error", [0.95])
    return spark.createDataFrame([(round(vals[0.95], DIGITS), n)], "threshold double, n bigint")


def q_error_summary(spark, sf_dir):
    s = error_summary(embedding_errors(spark, sf_dir))
    return s.select("n", *[_r(c).alias(c) for c in
                           ["min_error", "max_error", "mean_error", "p90", "p95", "p99"]])


def q_error_summary_by_label(spark, sf_dir):
    """A4 per group (the grouped radix passes behind the epoch history)."""
    s = error_summary(embedding_errors(spark, sf_dir), by=["label"])
    return s.select("label", "n", *[_r(c).alias(c) for c in
                                    ["min_error", "max_error", "mean_error", "p90", "p95", "p99"]])


def _detect(spark, errs, key_cols):
    # Scores are written once to the shared checkpoint folder: the threshold
    # passes and the final filter read the same rows instead of scoring twice.
    work_dir(spark)
    errs = errs.select(*key_cols, "recon_error").checkpoint(eager=True)
    thr = threshold(errs)
    return P.threshold_filter(errs, thr).select(*key_cols, _r("recon_error").alias("recon_error"))


def q_detect(spark, sf_dir):
    """Flagship: score every embedding, exact p95 threshold, keep those above."""
    return _detect(spark, embedding_errors(spark, sf_dir), ["vec_id", "label"])


def q_detect_logs(spark, sf_dir):
    """The whole log chain (M6) on events-as-logs, anomalies above p95.

    Many log lines have mathematically equal errors and p95 falls inside
    such a tie group, so the error is quantised to 12 places before the
    threshold in both engines; otherwise last-bit noise of the summation
    order would decide the strict comparison.
    """
    errs = (log_errors(spark, sf_dir).withColumnRenamed("RequestID", "event_id")
            .withColumn("recon_error", F.round("recon_error", TIE_DIGITS)))
    return _detect(spark, errs, ["event_id", "LogLevel", "Service", "Message", "TimeVal"])


def q_log_scores(spark, sf_dir):
    errs = log_errors(spark, sf_dir)
    return errs.select(F.col("RequestID").alias("event_id"), _r("recon_error").alias("recon_error"))


def q_run_metrics(spark, sf_dir):
    work_dir(spark)
    errs = embedding_errors(spark, sf_dir).checkpoint(eager=True)  # scored once, read twice
    thr = threshold(errs)
    return metrics_long(run_counts(errs, thr), run_id="r", with_time=False).select(
        "metric_name", _r("metric_value").alias("metric_value"))


def q_attach_scores(spark, sf_dir):
    """Prepared log lines joined to a score table (row_id, recon_error)
    that exists only for complete lines; the others disappear."""
    dirty = logs_view(spark, sf_dir, dirty=True).withColumn("row_id", F.col("_c0"))
    logs = P.prepare(dirty)
    scores = P.prepare(P.drop_incomplete_raw(dirty)).select(
        "row_id", (F.col("TimeVal").cast("double") / 1000.0).alias("recon_error"))
    joined = attach_scores(logs, scores, "row_id")
    return joined.select("row_id", "LogLevel", "Service", "Message", "TimeVal",
                         _r("recon_error").alias("recon_error"))


def q_attach_scores_bucketed(spark, sf_dir):
    """J1 over two tables bucketed by the row key: lines and scores join
    bucket by bucket, without an exchange."""
    from logscan.operators.join import write_bucketed

    base = fresh_dir(spark, "bucketed")
    name = base.rsplit("/", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS logscan_runs LOCATION '{work_dir(spark, 'warehouse', 'logscan_runs.db')}'")
    dirty = logs_view(spark, sf_dir, dirty=True).withColumn("row_id", F.col("_c0"))
    scores = P.prepare(P.drop_incomplete_raw(dirty)).select(
        "row_id", (F.col("TimeVal").cast("double") / 1000.0).alias("recon_error"))
    joined = attach_scores(write_bucketed(P.prepare(dirty), f"logscan_runs.lines_{name}", buckets=8, location=base + "/lines"),
                           write_bucketed(scores, f"logscan_runs.scores_{name}", buckets=8, location=base + "/scores"))
    return joined.select("row_id", "LogLevel", "Service", "Message", "TimeVal",
                         _r("recon_error").alias("recon_error"))


def q_dedupe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return P.dedupe(docs.select("lang", "text"))


def q_dedupe_by_text(spark, sf_dir):
    """P8 on business columns: one document per (lang, text) among exact
    copies (dropDuplicates, partial aggregation first), counted per language."""
    docs = read_table(spark, sf_dir, "documents")
    kept = P.dedupe(docs, on=["lang", "text"])
    return kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_texts"))


def q_topk(spark, sf_dir):
    errs = embedding_errors(spark, sf_dir)
    return P.top_k(errs, 10, "recon_error", tie_break=["vec_id"]).select(
        "vec_id", "label", _r("recon_error").alias("recon_error"))


def epoch_millis_ntz(c: str):
    """Epoch milliseconds of a TIMESTAMP_NTZ column, whatever the session
    time zone (truncating, like ``epoch_us(ts) // 1000``)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def upload_events(spark, sf_dir) -> DataFrame:
    """events as upload events: user_id names the file, ts is the upload."""
    ev = read_table(spark, sf_dir, "events")
    name = F.concat(F.lit("log"), F.col("user_id").cast("string"), F.lit(".csv"))
    path = F.when(F.col("event_id") % 2 == 0,
                  F.concat(F.lit("/data/uploads/"), F.col("event_id").cast("string"), F.lit("/"), name)) \
        .otherwise(F.concat(F.lit("C:\\uploads\\"), F.col("event_id").cast("string"), F.lit("\\"), name))
    return ev.select("event_id", "event_type", path.alias("filePath"), name.alias("fileName"),
                     epoch_millis_ntz("ts").alias("uploadTime"))


def q_latest_upload(spark, sf_dir):
    ev = upload_events(spark, sf_dir).select("fileName", "uploadTime", "filePath", "event_id")
    return latest_uploads(ev)


def q_object_key(spark, sf_dir):
    return upload_events(spark, sf_dir).select("event_id", object_key("filePath").alias("object_key"))


def q_decode_event(spark, sf_dir):
    """U1 round trip over every event: 'error' events carry malformed JSON
    (closing brace lost), 'signup' events lack uploadTime; both are kept and
    marked invalid."""
    enc = upload_events(spark, sf_dir)
    full = F.to_json(F.struct("filePath", "fileName", "uploadTime"))
    msgs = enc.select("event_id", F.when(F.col("event_type") == "error", F.regexp_replace(full, r"\}$", ""))
                      .when(F.col("event_type") == "signup", F.to_json(F.struct("filePath", "fileName")))
                      .otherwise(full).alias("value"))
    dec = decode_event(msgs, keep=["event_id"])
    return dec.select("event_id", "filePath", "fileName", "uploadTime", "is_valid")


def _run_detect_stream(spark, sf_dir) -> str:
    """The detect_logs chain as a Structured Streaming query over the events
    table (file source, availableNow); returns its output folder."""
    from logscan.streaming.detect_stream import finish_metrics, start_detect_stream

    events_schema = read_table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(events_schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    errs = log_errors(spark, sf_dir).withColumn("recon_error", F.round("recon_error", TIE_DIGITS))
    thr = threshold(errs)
    out = fresh_dir(spark, "stream_detect")
    q = start_detect_stream(spark, events_as_logs(stream), rank_one_model(EMBED_DIM, fixed_weight), thr,
                            out + "/anomalies", out + "/checkpoint", metrics_path=out + "/metrics",
                            available_now=True, fmt="parquet", round_digits=TIE_DIGITS,
                            input_partitions=input_partitions(spark))
    q.awaitTermination()
    finish_metrics(q)
    return out


def q_stream_detect(spark, sf_dir):
    """T1-T3 + S3: anomalies written by the stream, idempotent per batch; the
    threshold comes from the batch scores of the same table."""
    res = spark.read.parquet(_run_detect_stream(spark, sf_dir) + "/anomalies")
    return res.select(F.col("RequestID").alias("event_id"), "LogLevel", "Service", "Message", "TimeVal",
                      _r("recon_error").alias("recon_error"))


def q_stream_metrics(spark, sf_dir):
    """T3 second output + T5: the five run metrics of every batch; counts as
    they are, durations (different on each run) as whether they are above 0
    and the detection took no longer than the whole batch."""
    met = spark.read.parquet(_run_detect_stream(spark, sf_dir) + "/metrics")
    whole = F.max(F.when(F.col("metric_name") == "duration_sec", F.col("metric_value"))).over(
        Window.partitionBy("batch_id"))
    timed = ((F.col("metric_value") > 0) & (F.col("metric_value") <= whole)).cast("double")
    return met.withColumn("timed", timed).select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "metric_name",
        _r(F.when(F.col("metric_name").isin("duration_sec", "detect_sec"), F.col("timed"))
           .otherwise(F.col("metric_value"))).alias("metric_value"))


def other_weight(d: int) -> float:
    """Weights of a second test model."""
    return ((d * 5) % 13 - 6) / 50.0


def q_stream_reload(spark, sf_dir):
    """S10 + T3: one running stream over two files of events; between its two
    batches another model with another threshold becomes the current version
    of the store, and the second batch is scored by it."""
    from logscan.sources.model_store import save_model
    from logscan.streaming.detect_stream import finish_metrics, start_detect_stream

    base = fresh_dir(spark, "stream_reload")
    events = read_table(spark, sf_dir, "events")
    models = [rank_one_model(EMBED_DIM, w) for w in (fixed_weight, other_weight)]
    for model in models:
        model.meta = {"features": "tokens", "dim": EMBED_DIM}
    stream = events_as_logs(spark.readStream.schema(events.schema).parquet(base + "/landing/*"))
    q = None
    for part, model in enumerate(models):
        lines = P.scorable_lines(events_as_logs(events.where(F.col("event_id") % 2 == part)))
        errs = (lines.withColumn("slots", token_indices("text"))
                .withColumn("recon_error", F.round(recon_error(spark, model, "slots", kind="tokens"), TIE_DIGITS)))
        save_model(spark, model, threshold(errs), base + "/model")
        events.where(F.col("event_id") % 2 == part).coalesce(1).write.parquet(f"{base}/landing/{part}")
        if q is None:
            q = start_detect_stream(spark, stream, base + "/model", None, base + "/anomalies", base + "/checkpoint",
                                    metrics_path=base + "/metrics", trigger="0 seconds", fmt="parquet",
                                    round_digits=TIE_DIGITS, input_partitions=input_partitions(spark))
        q.processAllAvailable()
    q.stop()
    finish_metrics(q)
    res = spark.read.parquet(base + "/anomalies")
    return res.select(F.col("RequestID").alias("event_id"), F.col("batch_id").cast("bigint").alias("batch_id"),
                      _r("recon_error").alias("recon_error"))


def q_ae_sync(spark, sf_dir):
    """M2 by synchronous training, with two and with three tasks: rows trained
    on per epoch, and whether both runs have the same history."""
    from logscan.operators.sync_training import fit_synchronous

    emb = read_table(spark, sf_dir, "embeddings")
    two, three = (fit_synchronous(emb, "embedding", dims=(64, 16, 64), epochs=2, batch_size=512, lr=1e-3,
                                  partitions=p)[1] for p in (2, 3))
    rows = [(a[0], a[1], all(abs(x - y) <= 1e-9 for x, y in zip(a, b))) for a, b in zip(two, three)]
    return spark.createDataFrame(rows, "epoch int, n bigint, same boolean")


def q_pca_gram(spark, sf_dir):
    """The sums a PCA fit needs, added batch by batch (a third of the
    embeddings each, the second batch twice as after a failure) and read back
    from the store; one row per pair of dimensions."""
    from logscan.operators.gram import add_rows, read_sums

    path = fresh_dir(spark, "pca_gram")
    emb = read_table(spark, sf_dir, "embeddings")
    for batch in (0, 1, 1, 2):
        add_rows(emb.where(F.col("vec_id") % 3 == batch), "embedding", 64, path, batch)
    n, sums, gram = read_sums(spark, path, 64)
    rows = [(i + 1, j + 1, n, round(float(sums[i]), 6), round(float(gram[i, j]), 6)) for i in range(64) for j in range(i, 64)]
    return spark.createDataFrame(rows, "i int, j int, n bigint, sum_i double, product double")


def land_csv(spark, df, folder: str, name: str) -> None:
    """Write ``df`` as one CSV file ``folder/name``, replacing such a file."""
    part = fresh_dir(spark, "landing")
    df.coalesce(1).write.option("header", True).csv(part)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = target.getFileSystem(conf)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    file, = [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(part + "/part-*"))]
    fs.rename(file, target)


def q_stream_logs(spark, sf_dir):
    """S3 + T2: a folder whose file ``a.csv`` is uploaded twice, with other
    lines and another column order the second time; the stream reads both
    uploads, each in a batch of its own, bound by header."""
    from logscan.sources.file_events import stream_file_events, with_log_lines

    base = fresh_dir(spark, "stream_logs")
    lines = logs_view(spark, sf_dir).withColumn("Timestamp", F.date_format("Timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))

    batches = []  # those with lines: the moment without the file may make an empty one

    def write(batch, batch_id):
        if batch_id not in batches:
            batches.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{base}/lines/upload={batches.index(batch_id)}")

    q = None
    for part in (0, 1):
        own = lines.where(F.col("RequestID") % 2 == part)
        land_csv(spark, own.withColumnRenamed("_c0", "") if part == 0 else own.select(*reversed(own.columns[1:])),
                 base + "/uploads", "a.csv")
        if q is None:
            q = (stream_file_events(spark, base + "/uploads").writeStream.foreachBatch(with_log_lines(write))
                 .option("checkpointLocation", base + "/checkpoint").trigger(processingTime="0 seconds").start())
        q.processAllAvailable()
    q.stop()
    back = P.prepare(spark.read.parquet(base + "/lines"))
    return back.select(F.col("RequestID").alias("event_id"), F.col("upload").cast("bigint").alias("upload"),
                       F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                       "LogLevel", "Service", "Message", "TimeVal")


def q_pca_detect(spark, sf_dir):
    """M5 with PCA (k=64) on events-as-logs: md5 70/30 split, p95 threshold
    on train errors, anomalies of the test part."""
    from logscan.plans.fit import fit

    res = fit(logs_view(spark, sf_dir), method="pca", k=64)
    return res.test_anomalies.select(F.col("RequestID").alias("event_id"), "LogLevel", "Service",
                                     "Message", "TimeVal", _r("recon_error").alias("recon_error"))


def q_ae_history(spark, sf_dir):
    """M2 + A6 with the reference settings (768-256-64-256-768, Adam 1e-4,
    3 epochs, batch 32) on the train part of events-as-logs."""
    from logscan.plans.fit import fit

    res = fit(logs_view(spark, sf_dir), method="autoencoder")
    rows = [(e, n, round(m, DIGITS), round(p90, DIGITS), round(p95, DIGITS), round(res.threshold, DIGITS))
            for e, n, m, p90, p95 in res.history]
    return spark.createDataFrame(rows, "epoch int, n bigint, mean_loss double, p90 double, p95 double, "
                                       "threshold double")


def q_csv_roundtrip(spark, sf_dir):
    """S7 + S1 + P1: events written as a log CSV folder (header, blank first
    header cell, microsecond timestamps), read back with the declared
    schema (headers compared by the scan itself), then prepared."""
    from logscan.sources.logs import read_logs
    from logscan.sources.sinks import write_csv

    folder = fresh_dir(spark, "csv_roundtrip")
    write_csv(logs_view(spark, sf_dir), folder, mode="overwrite")
    back = P.prepare(read_logs(spark, folder, headers="scan"))
    return back.select(F.col("RequestID").alias("event_id"),
                       F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                       "LogLevel", "Service", "Message", "TimeVal")


def q_batch_run(spark, sf_dir):
    """M6 run_batch + S6 + S8/S9: a detection run over the events written as
    CSV uploads, anomalies appended to a CSV folder, the run metrics inserted
    into a metric table; returns the count metrics read back from the table."""
    from logscan.sources.sinks import create_metric_table, write_csv
    from logscan.plans.detect import run_batch

    base = fresh_dir(spark, "batch_run")
    write_csv(logs_view(spark, sf_dir), base + "/uploads", mode="overwrite")
    errs = log_errors(spark, sf_dir).withColumn("recon_error", F.round("recon_error", TIE_DIGITS))
    thr = threshold(errs)
    table = "logscan_runs.metrics_" + base.rsplit("/", 1)[-1]
    create_metric_table(spark, table, location=base + "/metrics",
                        database_location=work_dir(spark, "warehouse", "logscan_runs.db"))
    model = rank_one_model(EMBED_DIM, fixed_weight)
    run_batch(spark, base + "/uploads", model, thr, base + "/anomalies", metrics_table=table,
              run_id="batch-run", round_digits=TIE_DIGITS)
    return (spark.table(table).where(F.col("metric_name").isin("total_logs", "anomalies_count"))
            .select("metric_name", _r("metric_value").alias("metric_value")))


def q_staged_run(spark, sf_dir):
    """S6 + T2, staged: a run over half of the events is killed once its rows
    are committed; the other half arrives and the run starts again, then once
    more.  Every anomaly is in the CSV results once."""
    from logscan.plans.detect import run_batch
    from logscan.sources.sinks import write_csv
    from logscan.sources.staged import RESULT_SCHEMA, StagedResults

    class Killed(Exception):
        pass

    def kill():
        raise Killed

    base = fresh_dir(spark, "staged_run")
    model = rank_one_model(EMBED_DIM, fixed_weight)
    thr = threshold(log_errors(spark, sf_dir).withColumn("recon_error", F.round("recon_error", TIE_DIGITS)))
    lines = logs_view(spark, sf_dir)
    for part, after in ((0, kill), (1, None), (None, None)):
        if part is not None:
            write_csv(lines.where(F.col("RequestID") % 2 == part), base + "/uploads", mode="append")
        try:
            run_batch(spark, base + "/uploads", model, thr, base + "/results", round_digits=TIE_DIGITS, staged=True,
                      consume=True, metrics_path=base + "/metrics", after_commit=after)
        except Killed:
            continue
    res = StagedResults(spark, base + "/results").read(RESULT_SCHEMA)
    return res.select(F.col("RequestID").alias("event_id"), "LogLevel", "Service", "Message", "TimeVal",
                      _r("recon_error").alias("recon_error"))


def q_model_roundtrip(spark, sf_dir):
    """The test model saved as a layer table with its threshold, loaded
    back (size-checked) and used to score the embeddings."""
    from logscan.sources.model_store import load_model, save_model

    path = fresh_dir(spark, "model")
    errs = embedding_errors(spark, sf_dir)
    save_model(spark, rank_one_model(64, fixed_weight), threshold(errs), path)
    model, thr = load_model(spark, path)
    emb = read_table(spark, sf_dir, "embeddings")
    scored = emb.select("vec_id", "label", recon_error(spark, model, "embedding").alias("recon_error"))
    return P.threshold_filter(scored, thr).select("vec_id", "label", _r("recon_error").alias("recon_error"))


def q_row_ids(spark, sf_dir):
    """P5: the row key is unique over the whole prepared table (ids are not
    consecutive, so only their count and distinct count are compared)."""
    ids = P.with_row_id(P.prepare(logs_view(spark, sf_dir)))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("n_distinct"),
                   F.count_distinct("RequestID").alias("n_requests"))


def q_catalogue_stream(spark, sf_dir):
    """S4 stand-in + U1-U3 as a stream: every event written as one JSON line
    (the topic), decoded by the catalogue stream (availableNow), latest file
    per name with its object key, read back from the appended entries."""
    from logscan.operators.uploads import encode_event
    from logscan.streaming.uploads_stream import json_line_events, read_catalogue, start_catalogue

    base = fresh_dir(spark, "catalogue_stream")
    encode_event(upload_events(spark, sf_dir)).write.mode("overwrite").text(base + "/topic")
    q = start_catalogue(spark, json_line_events(spark, base + "/topic"), base + "/entries",
                        base + "/rejects", base + "/checkpoint", available_now=True)
    q.awaitTermination()
    return read_catalogue(spark, base + "/entries").select("fileName", "uploadTime", "filePath", "object_key",
                                                          "landing_key")


def q_catalogue_state(spark, sf_dir):
    """U3 as streaming state: the events in three files, one micro-batch each,
    every file with uploads older than those before it; the query stops after
    two and starts again from its checkpoint for the third."""
    from logscan.operators.uploads import encode_event
    from logscan.streaming.uploads_stream import json_line_events, read_catalogue, start_catalogue_state

    base = fresh_dir(spark, "catalogue_state")
    events = upload_events(spark, sf_dir)
    for parts in ((0, 1), (2,)):
        for part in parts:
            (encode_event(events.where(F.col("event_id") % 3 == part)).coalesce(1)
             .write.mode("append").text(base + "/topic"))
        q = start_catalogue_state(spark, json_line_events(spark, base + "/topic", 1), base + "/catalogue",
                                  base + "/checkpoint")
        q.awaitTermination()
    return read_catalogue(spark, base + "/catalogue").select("fileName", "uploadTime", "filePath", "object_key",
                                                            "landing_key")


def q_catalogue_batches(spark, sf_dir):
    """U3 after 20 micro-batches: runs merged in levels, read from the live ones."""
    from logscan.operators.uploads import encode_event
    from logscan.streaming.uploads_stream import json_line_events, read_catalogue, start_catalogue

    base = fresh_dir(spark, "catalogue_batches")
    encode_event(upload_events(spark, sf_dir)).repartition(20).write.text(base + "/topic")
    q = start_catalogue(spark, json_line_events(spark, base + "/topic", 1), base + "/catalogue", base + "/rejects",
                        base + "/checkpoint")
    q.awaitTermination()
    return read_catalogue(spark, base + "/catalogue").select("fileName", "uploadTime", "filePath", "object_key",
                                                            "landing_key")


def q_consume_once(spark, sf_dir):
    """T2 + S2: a batch run over the events written as an upload folder
    archives exactly the files it read; the next run finds nothing and ends
    quietly.  Returns the status and line count of both runs."""
    from logscan.plans.detect import run_batch
    from logscan.sources.sinks import write_csv

    base = fresh_dir(spark, "consume_once")
    write_csv(logs_view(spark, sf_dir), base + "/uploads", mode="overwrite")
    model = rank_one_model(EMBED_DIM, fixed_weight)
    runs = []
    for name, consume in (("first", True), ("second", True)):
        r = run_batch(spark, base + "/uploads", model, 1.0, base + "/anomalies", run_id=name,
                      consume=consume, archive_dir=base + "/archive")
        runs.append((name, r["status"], r.get("total_logs")))
    return spark.createDataFrame(runs, "run string, status string, total_logs double")


QUERIES = {
    "mask_message": q_mask_message,
    "mask_documents": q_mask_documents,
    "parse_time": q_parse_time,
    "compose_text": q_compose_text,
    "drop_incomplete": q_drop_incomplete,
    "split_bucket": q_split_bucket,
    "token_index": q_token_index,
    "recon_error_fixed": q_recon_error_fixed,
    "threshold": q_threshold,
    "error_summary": q_error_summary,
    "error_summary_by_label": q_error_summary_by_label,
    "detect": q_detect,
    "log_scores": q_log_scores,
    "detect_logs": q_detect_logs,
    "run_metrics": q_run_metrics,
    "attach_scores": q_attach_scores,
    "attach_scores_bucketed": q_attach_scores_bucketed,
    "dedupe": q_dedupe,
    "dedupe_by_text": q_dedupe_by_text,
    "topk": q_topk,
    "stream_detect": q_stream_detect,
    "stream_metrics": q_stream_metrics,
    "stream_reload": q_stream_reload,
    "stream_logs": q_stream_logs,
    "pca_detect": q_pca_detect,
    "pca_gram": q_pca_gram,
    "ae_history": q_ae_history,
    "ae_sync": q_ae_sync,
    "row_ids": q_row_ids,
    "consume_once": q_consume_once,
    "csv_roundtrip": q_csv_roundtrip,
    "batch_run": q_batch_run,
    "staged_run": q_staged_run,
    "model_roundtrip": q_model_roundtrip,
    "latest_upload": q_latest_upload,
    "catalogue_stream": q_catalogue_stream,
    "catalogue_state": q_catalogue_state,
    "catalogue_batches": q_catalogue_batches,
    "object_key": q_object_key,
    "decode_event": q_decode_event,
}
