"""M5: fitting a model and its threshold from log lines, without collects.

read -> prepare -> md5 split (M4) -> drop incomplete -> token features (M1)
-> model (PCA by default, or the autoencoder) -> errors on train -> exact
summary and p95 threshold -> errors on test -> anomalies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscan.functions.hashing import EMBED_DIM, split_label, token_vectors
from logscan.operators import prepare as P
from logscan.operators.autoencoder import LAYER_DIMS, fit_autoencoder
from logscan.operators.pca import fit_pca
from logscan.operators.score import Model, recon_error
from logscan.operators.stats import SUMMARY_PERCENTILES, THRESHOLD_PERCENTILE, summarize, summary_frame
from logscan.plans.detect import featurize
from logscan.session import spread


@dataclass
class FitResult:
    model: Model
    threshold: float
    summary: DataFrame
    history: list
    test_anomalies: DataFrame


def line_key(df: DataFrame) -> F.Column:
    """A content key of a log line (stable across runs and layouts)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in
            ("Timestamp", "LogLevel", "Service", "Message", "RequestID", "User", "ClientIP", "TimeTaken")
            if c in df.columns]
    return F.md5(F.concat_ws("\u0001", *cols))


def fit(logs: DataFrame, method: str = "pca", k: int = 64, dim: int = EMBED_DIM,
        train_percent: int = 70, percentile: float = THRESHOLD_PERCENTILE, epochs: int = 3,
        dims=None, lr: float = 1e-4, batch_size: int = 32, seed: int = 42,
        partitions: int | None = None, split: str = "hash", rounds: int = 1,
        input_partitions: int | None = None) -> FitResult:
    """``split='hash'`` (default) assigns lines by an md5 bucket of their
    content: repeatable across runs and layouts.  ``split='random'`` is
    ``randomSplit`` with ``seed``, as the reference does; it changes when
    the input is laid out differently."""
    spark = logs.sparkSession
    logs = spread(logs, input_partitions)
    # P4 on raw columns first (pushed into the reader); the content-hash split
    # assigns each line the same way before or after it.
    prepared = P.prepare(P.drop_incomplete_raw(logs)).withColumn("_key", line_key(logs))
    if split == "random":
        tr, te = prepared.randomSplit([train_percent / 100.0, 1 - train_percent / 100.0], seed=seed)
        prepared = tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
    else:
        prepared = prepared.withColumn("split", split_label("_key", train_percent))
    lines = featurize(P.with_text(prepared), dim, "slots")
    train = lines.where(F.col("split") == "train")
    test = lines.where(F.col("split") == "test")

    # The training slots feed the model fit and the training errors: computed
    # once (line rules and token hashing are the costly part), kept with
    # their lineage so a lost block is recomputed.
    train_slots = train.select("slots").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if train_slots.isEmpty():
            raise ValueError("no complete log line to train on")
        history = []
        if method == "pca":
            model = fit_pca(token_vectors(train_slots, "slots", dim), "features", k=k)
        elif method == "autoencoder":
            model, history = fit_autoencoder(train_slots, "slots", kind="tokens",
                                             dims=dims or (dim, *LAYER_DIMS[1:-1], dim), epochs=epochs,
                                             batch_size=batch_size, lr=lr, seed=seed, partitions=partitions,
                                             rounds=rounds)
        else:
            raise ValueError(f"unknown method {method!r}")
        model.meta = {**(model.meta or {}), "features": "tokens", "dim": dim}

        train_err = train_slots.select(
            recon_error(spark, model, "slots", kind="tokens", dim=dim).alias("recon_error"))
        probs = sorted(set(SUMMARY_PERCENTILES) | {float(percentile)})
        rows = summarize(train_err, "recon_error", probs)
        summary = summary_frame(spark, rows)
        thr = rows[0][float(percentile)] if rows else None
    finally:
        train_slots.unpersist()
    scored_test = test.withColumn("recon_error", recon_error(spark, model, "slots", kind="tokens", dim=dim))
    anomalies = P.result_columns(P.threshold_filter(scored_test, thr))
    return FitResult(model, thr, summary, history, anomalies)
