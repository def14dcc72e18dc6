"""Run by test_faults.py in its own process (local mode with task retries)."""

import json
import os
import sys
import tempfile

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, sys.argv[1])

from logscan.operators.autoencoder import fit_autoencoder  # noqa: E402
from logscan.operators.quantile import exact_quantiles  # noqa: E402
from logscan.operators.score import rank_one_model, recon_error  # noqa: E402
from logscan.operators.stats import threshold  # noqa: E402
from logscan.operators.sync_training import fit_synchronous  # noqa: E402
from logscan.session import work_dir  # noqa: E402


def flaky(fail: bool):
    """Identity over Arrow batches that fails the first attempt of every task."""

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        if fail and ctx.attemptNumber() == 0:
            raise RuntimeError(f"injected loss of task {ctx.partitionId()}")
        yield from batches

    return run


def lose_once(marker):
    """Fails one barrier task, once (the marker file says that it did)."""

    def on_task(context):
        if context.partitionId() == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("injected loss of a barrier task")

    return on_task


def main():
    spark = SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    work_dir(spark)
    emb = spark.read.parquet(sys.argv[2]).repartition(4)
    out = {}
    marker = os.path.join(tempfile.mkdtemp(), "lost")
    for fail in (False, True):
        src = emb.mapInArrow(flaky(fail), emb.schema)
        scored = src.select("vec_id", recon_error(spark, rank_one_model(64, lambda d: ((d * 7) % 11 - 5) / 40.0),
                                                  "embedding").alias("e"))
        (_, n, q), = exact_quantiles(scored, "e", [0.5, 0.95])
        ck = scored.checkpoint(eager=True)
        thr = threshold(ck, "e")
        ids = sorted(r.vec_id for r in ck.where(F.col("e") > thr).collect())
        model, hist = fit_autoencoder(src, "embedding", dims=(64, 8, 64), epochs=2, lr=1e-3, partitions=4)
        out[str(fail)] = {"n": n, "q": [q[0.5], q[0.95]], "ids": ids,
                          "loss": [h[2] for h in hist], "w0": float(np.sum(model.ws[0]))}
        sync, hist = fit_synchronous(emb, "embedding", dims=(64, 8, 64), epochs=2, lr=1e-3, batch_size=128, partitions=3,
                                     on_task=lose_once(marker) if fail else None)
        assert not fail or os.path.exists(marker)
        out[str(fail)] |= {"sync_loss": [h[2] for h in hist], "sync_w0": float(np.sum(sync.ws[0]))}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
