"""M2: autoencoder training by iterative parameter mixing.

One Spark job per epoch (``mapInArrow``).  Every partition starts from the broadcast weights
and Adam moments, runs minibatch Adam over its rows in an epoch-specific
order (a local sort, no shuffle), and emits (a) the error of each row as
seen in its minibatch and (b) its parameters and moments, weighted by its
row count and cut into fixed-size chunks.  A ``groupBy(chunk)`` then sums
the chunks across partitions (each group holds one chunk per partition, so
its size is bounded by the partition count, not by the data), and the
averaged parameters come back to the driver: a bounded, model-sized
transfer.  With one partition this is the plain sequential algorithm.

Reference hyper-parameters: 768-256-64-256-768, ReLU between layers, linear
output, Adam lr 1e-4, MSE, 3 epochs, batch 32.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscan.operators.score import MAX_BROADCAST_PARAMS, Model, dense_block, row_blocks, token_block
from logscan.operators.stats import epoch_history

# Fixed values (as in the reference): layer widths, epochs, batch size, rate.
LAYER_DIMS = (768, 256, 64, 256, 768)
EPOCHS = 3
BATCH_SIZE = 32
LEARNING_RATE = 1e-4
# Adam defaults.
BETA1, BETA2, EPS = 0.9, 0.999, 1e-8
CHUNK = 1 << 13  # doubles per parameter chunk (64 KB)
ADAM_RUN = 1 << 14  # numbers updated at a time (64 KB in float32)
FLUSH_STEPS = 16  # steps between two flushes of vanishing moments

_OUT_SCHEMA = "kind int, part int, chunk int, n long, err double, vals array<double>"


@dataclass
class AdamState:
    params: list  # [w0, b0, w1, b1, ...]
    m: list
    v: list
    t: float = 0.0
    grads: list | None = None  # written anew by every step

    @classmethod
    def fresh(cls, model: Model) -> "AdamState":
        params = [np.asarray(a, dtype=np.float64) for wb in zip(model.ws, model.bs) for a in wb]
        return cls(params, [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params])

    @property
    def shapes(self) -> list:
        return [p.shape for p in self.params]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (*self.params, *self.m, *self.v)]).astype(np.float64)

    @classmethod
    def from_flat(cls, shapes, flat: np.ndarray, t: float, dtype=np.float64) -> "AdamState":
        groups, i = [], 0
        for _ in range(3):
            group = []
            for s in shapes:
                size = int(np.prod(s))
                group.append(np.asarray(flat[i:i + size], dtype=dtype).reshape(s).copy())
                i += size
            groups.append(group)
        return cls(groups[0], groups[1], groups[2], t)

    def model(self, acts) -> Model:
        return Model([np.asarray(w, dtype=np.float64) for w in self.params[0::2]],
                     [np.asarray(b, dtype=np.float64) for b in self.params[1::2]], list(acts))


def gradients(params: list, acts, x: np.ndarray, elements: int, out: list | None = None) -> tuple[np.ndarray, list]:
    """(per-row errors, gradients of the squared error over ``elements``);
    ``out`` are arrays to write the gradients to."""
    ws, bs = params[0::2], params[1::2]
    hs, pre = [x], []
    h = x
    for w, b, act in zip(ws, bs, acts):
        a = h @ w + b
        pre.append(a)
        h = np.maximum(a, 0.0) if act == "relu" else a
        hs.append(h)
    diff = h - x
    errs = np.einsum("ij,ij->i", diff, diff) / x.shape[1]
    delta = 2.0 * diff / elements
    grads = [np.empty_like(p) for p in params] if out is None else out
    for i in range(len(ws) - 1, -1, -1):
        if acts[i] == "relu":
            delta = delta * (pre[i] > 0)
        np.matmul(hs[i].T, delta, out=grads[2 * i])
        delta.sum(axis=0, out=grads[2 * i + 1])
        if i:
            delta = delta @ ws[i].T
    return errs.astype(np.float64), grads


def apply_gradients(state: AdamState, grads: list, lr: float) -> None:
    """One Adam step, in place: p -= lr/c1 * m / (sqrt(v)/sqrt(c2) + eps), in
    runs of ``ADAM_RUN`` numbers: no parameter-sized array is allocated."""
    state.t += 1
    c1, c2 = 1 - BETA1 ** state.t, 1 - BETA2 ** state.t
    step, root_c2 = lr / c1, np.sqrt(c2)
    flush = int(state.t) % FLUSH_STEPS == 0
    for all_g, all_m, all_v, all_p in zip(grads, state.m, state.v, state.params):
        flat = [a.reshape(-1) for a in (all_g.astype(all_p.dtype, copy=False), all_m, all_v, all_p)]
        scratch = np.empty(min(ADAM_RUN, all_p.size), dtype=all_p.dtype)
        for i in range(0, all_p.size, ADAM_RUN):
            g, m, v, p = (a[i:i + ADAM_RUN] for a in flat)
            denom = scratch[:len(p)]
            m *= BETA1
            m += np.multiply(g, 1 - BETA1, out=denom)
            v *= BETA2
            g *= g
            g *= 1 - BETA2
            v += g
            np.sqrt(v, out=denom)
            if root_c2 != 1:  # after some 37,000 steps it is exactly 1
                denom /= root_c2
            denom += EPS
            np.divide(m, denom, out=denom)
            denom *= step
            p -= denom
            if flush:
                # The moments of weights without a gradient would end as
                # subnormal numbers (rounding keeps them from zero), which cost
                # many times a normal operation; a weight never feels them.
                for a in (m, v):
                    a[np.abs(a, out=denom) < np.finfo(a.dtype).tiny * 128] = 0


def adam_step(state: AdamState, acts, x: np.ndarray, lr: float) -> np.ndarray:
    """One Adam step on a minibatch (the mean over all its elements); returns
    per-row errors before the step."""
    if state.grads is None:
        state.grads = [np.empty_like(p) for p in state.params]
    errs, grads = gradients(state.params, acts, x, x.size, state.grads)
    apply_gradients(state, grads, lr)
    return errs


def local_epoch(state: AdamState, acts, blocks, batch_size: int, lr: float, dtype=np.float32):
    """Run minibatches over an iterator of row blocks; yields error arrays.

    Rows are cut into batches of ``batch_size`` across block borders, the
    last batch may be short (as a DataLoader without drop_last).
    """
    pending = None
    for x in blocks:
        x = x.astype(dtype, copy=False)
        if pending is not None and len(pending):
            x = np.vstack([pending, x])
        full = (len(x) // batch_size) * batch_size
        errs = [adam_step(state, acts, x[i:i + batch_size], lr) for i in range(0, full, batch_size)]
        pending = x[full:]
        if errs:
            yield np.concatenate(errs)
    if pending is not None and len(pending):
        yield adam_step(state, acts, pending, lr)


def _batch(kind, part, chunk, n, err, vals) -> pa.RecordBatch:
    size = len(err)
    if vals is None:
        vals_arr = pa.nulls(size, type=pa.list_(pa.float64()))
    else:
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in vals])]).astype(np.int32)
        vals_arr = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(vals)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), pa.array(np.full(size, part, np.int32)),
         pa.array(np.asarray(chunk, np.int32)), pa.array(np.asarray(n, np.int64)),
         pa.array(np.asarray(err, np.float64)), vals_arr],
        names=["kind", "part", "chunk", "n", "err", "vals"])


def _trainer(bc, acts, kind: str, dim: int, batch_size: int, lr: float):
    to_block = dense_block if kind == "dense" else token_block

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        shapes, flat0, t0 = bc.value
        state = AdamState.from_flat(shapes, flat0, t0, dtype=np.float32)
        n = 0
        blocks = (x for b in batches for x in row_blocks(b.column("features"), to_block, dim))
        for errs in local_epoch(state, acts, blocks, batch_size, lr):
            n += len(errs)
            yield _batch(0, part, np.full(len(errs), -1), np.ones(len(errs)), errs, None)
        if n:
            vals = np.concatenate([[state.t - t0], state.flat()]) * n
            chunks = [vals[i:i + CHUNK] for i in range(0, vals.size, CHUNK)]
            yield _batch(1, part, np.arange(len(chunks)), np.full(len(chunks), n),
                         np.full(len(chunks), np.nan), chunks)

    return run


_SUM_SCHEMA = "chunk int, n long, vals array<double>"


def _sum_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(pdf["vals"].iloc[0]))
    for v in pdf["vals"]:
        total += v
    return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "n": [int(pdf["n"].sum())],
                         "vals": [total]})


def mix(params: DataFrame, n_parts: int) -> DataFrame:
    """Sum the weighted parameter chunks of all partitions in two levels.

    Level one sums groups of about sqrt(P) partitions per chunk, level two
    the group sums, so no group holds more than ~sqrt(P) chunks of 64 KB
    whatever the partition count.
    """
    fan = max(1, math.isqrt(max(n_parts - 1, 0)) + 1)
    level1 = (params.groupBy("chunk", (F.col("part") % F.lit(fan)).alias("_g"))
              .applyInPandas(_sum_chunks, _SUM_SCHEMA))
    return level1.groupBy("chunk").applyInPandas(_sum_chunks, _SUM_SCHEMA)


def training_layout(df: DataFrame, features: str, partitions: int | None = None):
    """The training rows, spread and checkpointed once: (frame, partitions).

    Rows are spread by a per-row id, not by a content key: copies of one
    line (possibly a third of all rows) must not share a partition.  The
    ids are fixed by the checkpoint, so the layout and the per-epoch order
    (a hash of id, seed and epoch) are the same when a partition is redone.
    """
    data = df.select(F.col(features).alias("features")).withColumn("_uid", F.monotonically_increasing_id())
    n_parts = partitions or max(1, data.rdd.getNumPartitions())
    return data.repartition(n_parts, "_uid").checkpoint(eager=True), n_parts


def fit_autoencoder(df: DataFrame, features: str, key: str | None = None, kind: str = "dense",
                    dims=LAYER_DIMS, epochs: int = EPOCHS, batch_size: int = BATCH_SIZE,
                    lr: float = LEARNING_RATE, seed: int = 42, partitions: int | None = None,
                    rounds: int = 1, verbose: bool = False):
    """Train on ``features`` (dense arrays or token slots); returns
    (Model, history rows [(epoch, n, mean_loss, p90, p95)]).

    ``key`` is accepted for callers that have one; rows are laid out by an
    id fixed at the checkpoint, so a lost partition is recomputed with the
    same rows in the same order.  ``rounds`` > 1 splits every epoch into that
    many disjoint row subsets (by a hash of the row id), each trained and
    mixed in its own job: more synchronisation when partitions are many.
    """
    from logscan.session import ship_package, work_dir

    spark = df.sparkSession
    ship_package(spark)
    work_dir(spark)  # make sure a checkpoint folder is registered
    dim = int(dims[0])
    model = Model.init(dims, seed=seed)
    if model.n_params * 3 > MAX_BROADCAST_PARAMS:
        raise ValueError(f"{model.n_params} parameters: too large for broadcast mixing")
    acts = model.acts
    state = AdamState.fresh(model)
    shapes = state.shapes

    t_start = time.perf_counter()
    data, n_parts = training_layout(df, features, partitions)
    if verbose:
        print(f"training data: {n_parts} partitions, {time.perf_counter() - t_start:.2f}s")

    flat, t = state.flat(), 0.0
    outs, errors = [], None
    try:
        for epoch in range(1, epochs + 1):
            t_epoch = time.perf_counter()
            for rnd in range(rounds):
                bc = spark.sparkContext.broadcast((shapes, flat, t))
                part = data if rounds == 1 else data.where(
                    F.pmod(F.xxhash64("_uid", F.lit(seed), F.lit(epoch), F.lit(-1)), F.lit(rounds)) == rnd)
                ordered = part.sortWithinPartitions(F.xxhash64("_uid", F.lit(seed), F.lit(epoch)), "_uid")
                out = (ordered.select("features")
                       .mapInArrow(_trainer(bc, acts, kind, dim, batch_size, lr), _OUT_SCHEMA)
                       .persist(StorageLevel.MEMORY_AND_DISK))
                parts = mix(out.where("kind = 1"), n_parts).orderBy("chunk").collect()
                # only the 8-byte row errors are kept, not the parameter rows
                errs = out.where("kind = 0").select(F.lit(epoch).alias("epoch"), F.col("err").alias("recon_error"))
                errs = errs.persist(StorageLevel.MEMORY_AND_DISK)
                errs.count()
                out.unpersist()
                outs.append((errs, bc))
                if not parts:  # no rows in this round
                    continue
                total_n = parts[0]["n"]
                vals = np.concatenate([np.asarray(r["vals"]) for r in parts]) / total_n
                t = t + float(vals[0])
                flat = vals[1:]
                errors = errs if errors is None else errors.unionByName(errs)
            if verbose:
                print(f"epoch {epoch}/{epochs} ({time.perf_counter() - t_epoch:.2f}s)")
        # A6 for all epochs at once: one grouped pass set over the kept errors
        history = [(int(h["epoch"]), int(h["n"]), float(h["mean_loss"]), float(h["p90"]), float(h["p95"]))
                   for h in epoch_history(errors).collect()] if errors is not None else []
        if verbose:
            for h in history:
                print(f"epoch {h[0]} loss {h[2]:.6f} p90 {h[3]:.6f} p95 {h[4]:.6f}")
    finally:
        for kept, bc in outs:
            kept.unpersist()
            bc.unpersist()
    final = AdamState.from_flat(shapes, flat, t).model(acts)
    final.meta = {"kind": "autoencoder", "dim": dim, "features": kind}
    return final, history
