"""Command line: ``python -m logscan {fit,detect,stream,catalogue} ...``

Meant to be launched with ``spark-submit`` (or plain ``python`` for a local
session); cluster settings come from the submit configuration.

  fit        train a model and its threshold from log CSVs and store them
  detect     one detection run over every file now in a folder (batch)
  stream     detection over a folder that keeps receiving files
  catalogue  upload events (JSON lines or Kafka) -> current file per name
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    from logscan.session import BASE_CONF, SQL_TUNING, work_dir

    builder = SparkSession.builder.appName(f"logscan-{args.command}")
    if args.master:
        builder = builder.master(args.master)
    for k, v in {**BASE_CONF, **SQL_TUNING}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    work_dir(spark)
    return spark


def cmd_fit(args) -> dict:
    from logscan.plans.fit import fit
    from logscan.sources.logs import read_logs
    from logscan.sources.model_store import save_model
    from logscan.sources.sinks import write_csv

    spark = _session(args)
    res = fit(read_logs(spark, args.input), method=args.method, k=args.k, epochs=args.epochs,
              lr=args.lr, batch_size=args.batch_size, seed=args.seed, percentile=args.percentile,
              partitions=args.partitions, rounds=args.rounds)
    save_model(spark, res.model, res.threshold, args.model)
    if args.anomalies:
        write_csv(res.test_anomalies, args.anomalies, mode="overwrite", single_file=args.single_file)
    summary = res.summary.first()
    return {"threshold": res.threshold, "summary": summary.asDict() if summary else None,
            "history": res.history}


def cmd_detect(args) -> dict:
    from logscan.plans.detect import run_batch
    from logscan.sources.model_store import load_model
    from logscan.sources.sinks import create_metric_table

    spark = _session(args)
    model, thr = load_model(spark, args.model)
    if args.metrics_table:
        create_metric_table(spark, args.metrics_table)
    return run_batch(spark, args.input, model, thr if args.threshold is None else args.threshold,
                     args.result, metrics_table=args.metrics_table, metrics_path=args.metrics_path,
                     single_file=args.single_file, consume=args.consume, archive_dir=args.archive,
                     precision=args.precision)


def cmd_stream(args) -> dict:
    from logscan.streaming.detect_stream import finish_metrics, start_detect_stream

    spark = _session(args)
    # the store's path, not a model: versions saved later are used from the next batch on
    q = start_detect_stream(spark, args.input, args.model, args.threshold,
                            args.result, args.checkpoint, metrics_path=args.metrics_path,
                            trigger=args.trigger, available_now=args.available_now,
                            archive_dir=args.archive, max_files_per_trigger=args.max_files_per_trigger,
                            input_partitions=args.input_partitions, file_events=args.file_events)
    q.awaitTermination()
    finish_metrics(q)
    return {"query_id": str(q.id), "last_progress": q.lastProgress}


def cmd_catalogue(args) -> dict:
    from logscan.streaming.uploads_stream import json_line_events, kafka_events, start_catalogue

    spark = _session(args)
    events = (kafka_events(spark, args.kafka) if args.kafka else json_line_events(spark, args.input))
    q = start_catalogue(spark, events, args.catalogue, args.rejects, args.checkpoint,
                        available_now=args.available_now)
    q.awaitTermination()
    return {"query_id": str(q.id)}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="logscan")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    f = sub.add_parser("fit", help="train model and threshold")
    f.add_argument("--input", required=True, help="log CSV file or folder")
    f.add_argument("--model", required=True, help="model folder to write")
    f.add_argument("--method", choices=["pca", "autoencoder"], default="pca")
    f.add_argument("--k", type=int, default=64)
    f.add_argument("--epochs", type=int, default=3)
    f.add_argument("--lr", type=float, default=1e-4)
    f.add_argument("--batch-size", type=int, default=32)
    f.add_argument("--seed", type=int, default=42)
    f.add_argument("--percentile", type=float, default=0.95)
    f.add_argument("--partitions", type=int, default=None, help="autoencoder training partitions")
    f.add_argument("--rounds", type=int, default=1, help="parameter mixing rounds per epoch")
    f.add_argument("--anomalies", default=None, help="CSV folder for the test-part anomalies")
    f.add_argument("--single-file", action="store_true")
    f.set_defaults(fn=cmd_fit)

    d = sub.add_parser("detect", help="one batch detection run")
    d.add_argument("--input", required=True)
    d.add_argument("--model", required=True)
    d.add_argument("--result", required=True, help="CSV folder, appended")
    d.add_argument("--threshold", type=float, default=None, help="override the stored threshold")
    d.add_argument("--metrics-table", default=None)
    d.add_argument("--metrics-path", default=None)
    d.add_argument("--single-file", action="store_true")
    d.add_argument("--consume", action="store_true", help="remove the files that were read")
    d.add_argument("--archive", default=None, help="move read files here instead of deleting")
    d.add_argument("--precision", choices=["float64", "float32"], default="float64")
    d.set_defaults(fn=cmd_detect)

    s = sub.add_parser("stream", help="detection over a landing folder")
    s.add_argument("--input", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--result", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--threshold", type=float, default=None)
    s.add_argument("--metrics-path", default=None)
    s.add_argument("--trigger", default="3 minutes")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--archive", default=None)
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--input-partitions", type=int, default=None, help="tasks per micro-batch")
    s.add_argument("--file-events", action="store_true", help="read replaced files again, bind columns by header")
    s.set_defaults(fn=cmd_stream)

    c = sub.add_parser("catalogue", help="upload events to the current-file catalogue")
    c.add_argument("--input", default=None, help="folder of JSON-lines event files")
    c.add_argument("--kafka", default=None, help="bootstrap servers (needs the Kafka package)")
    c.add_argument("--catalogue", required=True)
    c.add_argument("--rejects", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--available-now", action="store_true")
    c.set_defaults(fn=cmd_catalogue)

    args = p.parse_args(argv)
    print(json.dumps(args.fn(args), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
