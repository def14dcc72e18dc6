"""M2: synchronous autoencoder training, one Spark job per step.

The other trainer (``autoencoder.fit_autoencoder``) lets every partition train
alone and averages parameters, so its result depends on the partition count.
Here all tasks take every step together: a step's minibatch is spread over the
tasks, each sums the gradient over its own rows for the broadcast weights, the
driver adds the sums in task order and makes the Adam step.  The weights are
those of one sequential run over the same minibatches, whatever the number of
partitions (up to rounding).

Minibatches: in every epoch a row goes to the step that a hash of its id, the
seed and the epoch names, one of ceil(rows / batch_size) steps; their sizes
vary around ``batch_size`` and do not depend on the layout.

Layout: an epoch's rows are written once, in windows of consecutive steps; a
window is held as one block per step and task, so a step reads its window and
not the epoch.  When a window is done, one job repeats its forward passes with
the weights of each of its steps and writes the row errors, so they do not pass
through the driver.  A lost task is redone from the epoch's files and its
broadcast weights, to the same result.

A step is a job of its own, some hundredths of a second (an exchange inside a
barrier stage takes Spark a second), and moves one gradient per task to the
driver, so this is for large minibatches and for models and partition counts
whose product stays small (``MAX_EXCHANGED`` numbers a step); otherwise use
parameter mixing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscan.operators.autoencoder import (BATCH_SIZE, EPOCHS, LAYER_DIMS, LEARNING_RATE, AdamState, apply_gradients,
                                           gradients, training_layout)
from logscan.operators.score import Model, dense_block, token_block
from logscan.operators.stats import epoch_history
from logscan.session import fresh_dir, ship_package, work_dir

MAX_EXCHANGED = 1 << 23  # gradient numbers per step at the driver (64 MB)
# Design values: steps of a window, and the numbers its blocks or its weights may hold (16 MB).
WINDOW_STEPS = 64
WINDOW_NUMBERS = 1 << 21


def step_of(uid, seed: int, epoch: int, n_steps: int):
    """The step of an epoch that a row takes part in."""
    return F.pmod(F.xxhash64(uid, F.lit(seed), F.lit(epoch), F.lit(-2)), F.lit(n_steps)).cast("int")


def _rows_by_step(batches, to_block, dim: int):
    """(step, rows) of a partition sorted by step; a step may span batches."""
    step, parts = None, []
    for b in batches:
        steps = b.column("step").to_numpy()
        x = to_block(b.column("features"), dim).astype(np.float64, copy=False)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(steps)) + 1, [len(steps)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo == hi:
                continue
            if step is not None and steps[lo] != step:
                yield step, np.vstack(parts)
                parts = []
            step = int(steps[lo])
            parts.append(x[lo:hi])
    if parts:
        yield step, np.vstack(parts)


def _to_blocks(kind: str, dim: int):
    """Arrow function: rows sorted by step -> (step, their float64 block)."""
    to_block = dense_block if kind == "dense" else token_block

    def run(batches):
        for step, x in _rows_by_step(batches, to_block, dim):
            yield pa.RecordBatch.from_arrays([pa.array([step], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                                             names=["step", "block"])

    return run


def _step_gradients(bc, acts, dim: int, step: int, on_task):
    """RDD function: (rows, gradient sums over them) of the task's block of ``step``."""

    def run(blocks):
        if on_task:
            from pyspark import TaskContext

            on_task(TaskContext.get())
        for b in blocks:
            if b["step"] == step:
                x = np.frombuffer(b["block"]).reshape(-1, dim)
                _, grads = gradients(bc.value, acts, x, dim)  # sums over rows
                yield len(x), np.concatenate([g.ravel() for g in grads])

    return run


def _block_errors(bc, acts, dim: int):
    """Arrow function: row errors of blocks, each by the weights its step began with."""

    def run(batches):
        for b in batches:
            for step, block in zip(b.column("step").to_pylist(), b.column("block")):
                ws_bs = bc.value[step]
                x = np.frombuffer(block.as_buffer()).reshape(-1, dim)
                errs = Model(ws_bs[0::2], ws_bs[1::2], acts).errors(x)
                yield pa.RecordBatch.from_arrays([pa.array(errs, pa.float64())], names=["recon_error"])

    return run


def _sync_window(state: AdamState, blocks: DataFrame, steps, acts, dim: int, lr: float, on_task, errors_path: str):
    """Take the steps of one window and write the errors of its rows; ``on_task``
    is for its first step."""
    sc = blocks.sparkSession.sparkContext
    held, used = blocks.rdd, {}
    for step in steps:
        used[step] = [p.copy() for p in state.params]
        bc = sc.broadcast(used[step])
        n, total = 0, np.zeros(sum(p.size for p in state.params))
        for k, own in held.mapPartitions(_step_gradients(bc, acts, dim, step, on_task)).collect():  # in task order
            n += k
            total += own
        on_task = None
        bc.destroy()
        if n:
            flat_grad, at, grads = total / n, 0, []
            for p in state.params:
                grads.append(flat_grad[at:at + p.size].reshape(p.shape).copy())
                at += p.size
            apply_gradients(state, grads, lr)
    bc = sc.broadcast(used)
    blocks.mapInArrow(_block_errors(bc, acts, dim), "recon_error double").write.parquet(errors_path)
    bc.destroy()


def fit_synchronous(df: DataFrame, features: str, kind: str = "dense", dims=LAYER_DIMS, epochs: int = EPOCHS,
                    batch_size: int = BATCH_SIZE, lr: float = LEARNING_RATE, seed: int = 42,
                    partitions: int | None = None, on_task=None):
    """Train on ``features`` (dense arrays or token slots); returns
    (Model, history rows [(epoch, n, mean_loss, p90, p95)]).

    Every step takes ``partitions`` tasks.  ``on_task`` is called with the
    task context in the first step of each epoch (fault injection in tests).
    """
    spark = df.sparkSession
    ship_package(spark)
    work_dir(spark)
    dim = int(dims[0])
    model = Model.init(dims, seed=seed)
    data, n_parts = training_layout(df, features, partitions)
    if model.n_params * n_parts > MAX_EXCHANGED:
        raise ValueError(f"{model.n_params} gradients of {n_parts} tasks a step: use fit_autoencoder")
    rows = data.count()
    n_steps = -(-rows // batch_size)
    size = max(1, min(WINDOW_STEPS, WINDOW_NUMBERS // max(batch_size * dim, model.n_params)))
    state = AdamState.fresh(model)
    folder, errors = fresh_dir(spark, "sync_training"), None
    data = data.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(n_parts)))
    for epoch in range(1, epochs + 1 if rows else 1):
        step = step_of("_uid", seed, epoch, n_steps)
        own = data.select("features", "_uid", "part", step.alias("step")).withColumn(
            "window", F.floor(F.col("step") / size).cast("int"))
        own.sortWithinPartitions("window").write.partitionBy("window").parquet(f"{folder}/rows/{epoch}")
        laid = spark.read.schema(own.schema).parquet(f"{folder}/rows/{epoch}")
        for first in range(0, n_steps, size):
            blocks = (laid.where(F.col("window") == first // size).repartitionById(n_parts, "part")
                      .sortWithinPartitions("step", "_uid").select("features", "step")
                      .mapInArrow(_to_blocks(kind, dim), "step int, block binary").persist(StorageLevel.MEMORY_AND_DISK))
            try:
                _sync_window(state, blocks, range(first, min(first + size, n_steps)), model.acts, dim, lr,
                             on_task if first == 0 else None, f"{folder}/errors/{epoch}/window={first // size}")
            finally:
                blocks.unpersist()
        errs = spark.read.schema("recon_error double, window int").parquet(f"{folder}/errors/{epoch}").select(
            F.lit(epoch).alias("epoch"), "recon_error")
        errors = errs if errors is None else errors.unionByName(errs)
    history = [] if errors is None else [
        (int(h["epoch"]), int(h["n"]), float(h["mean_loss"]), float(h["p90"]), float(h["p95"]))
        for h in epoch_history(errors).collect()]
    final = state.model(model.acts)
    final.meta = {"kind": "autoencoder", "dim": dim, "features": kind}
    return final, history
