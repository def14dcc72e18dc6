"""PCA from sums that new data adds to.

The fit needs three sums over the rows: their number, the feature sums and the
upper triangle of the Gramian.  Each batch of rows is reduced to these sums
once (per partition, then in two levels) and kept as a table of fixed-size
chunks in a ``RunStore``: a batch that is added again replaces its own sums,
and merging runs means adding them.  A refit reads the table of sums, never
the rows again, and gives the model a fit over all rows would give.

The covariance is Gramian / n - mean mean': for features far from 0 compared
with their spread that difference loses digits (log lines and embeddings are
of length 1 here).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.operators.autoencoder import _OUT_SCHEMA, _SUM_SCHEMA, CHUNK, _batch, _sum_chunks, mix
from logscan.operators.score import Model, dense_block, token_block
from logscan.session import ship_package
from logscan.sources.run_store import RunStore

MAX_DIM = 8192  # the d x d matrix is decomposed on the driver (512 MB at this width)


def _partial_sums(kind: str, dim: int):
    to_block = dense_block if kind == "dense" else token_block

    def run(batches):
        from pyspark import TaskContext

        n, s, g = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = to_block(b.column("features"), dim).astype(np.float64, copy=False)
            n += len(x)
            s += x.sum(axis=0)
            g += x.T @ x
        if n:
            values = np.concatenate([[n], s, g[np.triu_indices(dim)]])
            chunks = [values[i:i + CHUNK] for i in range(0, values.size, CHUNK)]
            yield _batch(1, TaskContext.get().partitionId(), np.arange(len(chunks)), np.full(len(chunks), n),
                         np.full(len(chunks), np.nan), chunks)

    return run


def row_sums(df: DataFrame, features: str, dim: int, kind: str = "dense") -> DataFrame:
    """(chunk, n, vals): number, sums and Gramian of the rows with features."""
    if dim > MAX_DIM:
        raise ValueError(f"{dim} features: the covariance would not fit on the driver")
    ship_package(df.sparkSession)
    rows = df.where(F.col(features).isNotNull()).select(F.col(features).alias("features"))
    parts = rows.mapInArrow(_partial_sums(kind, dim), _OUT_SCHEMA)
    return mix(parts, max(1, rows.rdd.getNumPartitions()))


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("chunk").applyInPandas(_sum_chunks, _SUM_SCHEMA)


def gram_store(spark: SparkSession, path: str) -> RunStore:
    return RunStore(spark, path, "chunk", _added, buckets=1)


def add_rows(df: DataFrame, features: str, dim: int, path: str, batch: int, kind: str = "dense") -> None:
    """Add the sums of a batch of rows; the last batch may be added again."""
    gram_store(df.sparkSession, path).commit(batch, row_sums(df, features, dim, kind))


def read_sums(spark: SparkSession, path: str, dim: int):
    """(n, sums, Gramian) over all batches."""
    rows = gram_store(spark, path).read()
    found = rows.orderBy("chunk").collect() if rows is not None else []  # d^2 / 2 numbers
    if not found:
        return 0, np.zeros(dim), np.zeros((dim, dim))
    values = np.concatenate([np.asarray(r["vals"]) for r in found])
    g = np.zeros((dim, dim))
    g[np.triu_indices(dim)] = values[1 + dim:]
    return int(values[0]), values[1:1 + dim], g + np.triu(g, 1).T


def fit_sums(n: int, sums: np.ndarray, gram: np.ndarray, k: int = 64) -> Model:
    """The PCA model (as ``pca.fit_pca``) of rows known by their sums."""
    if not n:
        raise ValueError("no row to fit on")
    d = len(sums)
    k = min(k, d)
    mu = sums / n
    _, axes = np.linalg.eigh(gram / n - np.outer(mu, mu))
    pc = np.ascontiguousarray(axes[:, ::-1][:, :k])
    return Model([pc, pc.T.copy()], [-(mu @ pc), mu], ["linear", "linear"], meta={"kind": "pca", "k": k, "dim": d})


def fit_pca_sums(spark: SparkSession, path: str, dim: int, k: int = 64) -> Model:
    """Refit from the stored sums, without reading a row."""
    return fit_sums(*read_sums(spark, path, dim), k=k)
