"""M3: reconstruction error of a dense feed-forward model, in Arrow batches.

A model is a short list of dense layers ``y = act(x @ w + b)``; the last
layer reconstructs the input.  It is stored as a layer table (one row per
layer) and shipped to executors as one broadcast after its size is checked.
The scoring function is a scalar Arrow UDF: only the feature column crosses
into Python, other columns stay in the JVM row, and the score of a row does
not depend on which rows share its batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.functions.hashing import EMBED_DIM
from logscan.schema import LAYER_SCHEMA
from logscan.session import ship_package

# Upper bound on parameters shipped by broadcast (8 bytes each: 256 MB).
MAX_BROADCAST_PARAMS = 32_000_000
ACTIVATIONS = ("linear", "relu")
BLOCK_ROWS = 256  # rows per matrix product, whatever the batch size


@dataclass
class Model:
    """Dense layers; ``ws[i]`` has shape (in, out)."""

    ws: list
    bs: list
    acts: list
    meta: dict = field(default_factory=dict)

    @property
    def input_dim(self) -> int:
        return int(self.ws[0].shape[0])

    @property
    def n_params(self) -> int:
        return int(sum(w.size + b.size for w, b in zip(self.ws, self.bs)))

    def forward(self, x: np.ndarray) -> np.ndarray:
        h = x
        for w, b, act in zip(self.ws, self.bs, self.acts):
            h = h @ w + b
            if act == "relu":
                np.maximum(h, 0.0, out=h)
        return h

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Per-row mean squared reconstruction error."""
        d = self.forward(x) - x
        return np.einsum("ij,ij->i", d, d) / x.shape[1]

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, int(w.shape[0]), int(w.shape[1]), w.ravel().astype(float).tolist(),
                 b.astype(float).tolist(), a)
                for i, (w, b, a) in enumerate(zip(self.ws, self.bs, self.acts))]
        return spark.createDataFrame(rows, LAYER_SCHEMA)

    @classmethod
    def from_df(cls, layers: DataFrame) -> "Model":
        """Load a layer table after checking it is small enough to broadcast."""
        size = layers.agg(F.sum(F.col("rows") * F.col("cols") + F.col("cols")).alias("n")).first()["n"]
        if size is None:
            raise ValueError("empty model table")
        if size > MAX_BROADCAST_PARAMS:
            raise ValueError(f"model has {size} parameters, above the broadcast bound "
                             f"{MAX_BROADCAST_PARAMS}")
        ws, bs, acts = [], [], []
        for r in layers.orderBy("layer").collect():
            ws.append(np.asarray(r["w"], dtype=np.float64).reshape(r["rows"], r["cols"]))
            bs.append(np.asarray(r["b"], dtype=np.float64))
            acts.append(r["act"])
        return cls(ws, bs, acts)

    @classmethod
    def init(cls, dims, seed: int = 42, acts=None) -> "Model":
        """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) weights and biases, the usual
        default of a dense layer; ReLU between layers, linear output."""
        rng = np.random.default_rng(seed)
        ws, bs = [], []
        for a, b in zip(dims[:-1], dims[1:]):
            bound = 1.0 / np.sqrt(a)
            ws.append(rng.uniform(-bound, bound, size=(a, b)))
            bs.append(rng.uniform(-bound, bound, size=b))
        if acts is None:
            acts = ["relu"] * (len(ws) - 1) + ["linear"]
        return cls(ws, bs, list(acts))


def broadcast_model(spark: SparkSession, model: Model):
    if model.n_params > MAX_BROADCAST_PARAMS:
        raise ValueError(f"model too large to broadcast: {model.n_params} parameters")
    return spark.sparkContext.broadcast((model.ws, model.bs, model.acts))


def _values(arr: pa.Array) -> pa.Array:
    """Flat child values of a (possibly sliced) list array, nulls as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return arr.flatten()


def dense_block(arr: pa.Array, dim: int) -> np.ndarray:
    """An (n, dim) float64 block from a list column of width ``dim``."""
    n = len(arr)
    if n == 0:
        return np.zeros((0, dim))
    there = arr.is_valid().to_numpy(zero_copy_only=False)
    lens = pc.list_value_length(arr).fill_null(dim).to_numpy(zero_copy_only=False)
    if not np.all(lens == dim):
        raise ValueError(f"feature width differs from the model's {dim}")
    out = np.zeros((n, dim))  # null rows: their score is null
    out[there] = _values(arr).to_numpy(zero_copy_only=False).reshape(-1, dim)
    return out


def token_block(arr: pa.Array, dim: int) -> np.ndarray:
    """Bag-of-hashed-tokens block: counts per slot, L2-normalised per row.

    Mean pooling over tokens followed by L2 normalisation equals normalised
    counts, so only counts are formed; built from the flat slot values and
    the list lengths in one vectorised step.
    """
    n = len(arr)
    lens = pc.list_value_length(arr).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if n == 0 or lens.sum() == 0:
        return np.zeros((n, dim))
    flat = _values(arr).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if flat.min() < 0 or flat.max() >= dim:
        raise ValueError(f"token slot outside 0..{dim - 1}: slots and model width disagree")
    rows = np.repeat(np.arange(n, dtype=np.int64), lens)
    m = np.bincount(rows * dim + flat, minlength=n * dim).astype(np.float64).reshape(n, dim)
    norm = np.sqrt(np.einsum("ij,ij->i", m, m))
    norm[norm == 0] = 1.0
    return m / norm[:, None]


def row_blocks(arr: pa.Array, to_block, dim: int):
    """The dense blocks of ``BLOCK_ROWS`` rows each of a list column (the last
    one shorter): an Arrow batch is never dense as a whole."""
    for i in range(0, len(arr), BLOCK_ROWS):
        yield to_block(arr.slice(i, BLOCK_ROWS), dim)


def _forward_errors(params, blocks, dim: int, dtype=np.float64) -> np.ndarray:
    """Errors of the rows of ``blocks`` (see ``row_blocks``), in order."""
    ws, bs, acts = params
    if dtype != np.float64:
        ws = [w.astype(dtype) for w in ws]
        bs = [b.astype(dtype) for b in bs]
    model, out = Model(ws, bs, acts), [np.zeros(0)]
    # Blocks of one height, the last one padded: matrix kernels choose their
    # summation order by shape, so a row's score would else depend on how many
    # rows share its Arrow batch.
    block = np.zeros((BLOCK_ROWS, dim), dtype=dtype)
    for x in blocks:
        k = len(x)
        block[:k] = x
        block[k:] = 0
        out.append(model.errors(block)[:k].astype(np.float64))
    return np.concatenate(out)


def make_scorer(spark: SparkSession, model: Model, kind: str = "dense", dim: int | None = None,
                precision: str = "float64"):
    """A function column -> reconstruction error column, with one broadcast
    of the model shared by every use (e.g. all micro-batches of a stream).

    kind='dense': features is array<float|double> of width model.input_dim.
    kind='tokens': features is array<int> of hashed token slots (M1).
    A scalar Arrow UDF: the column arrives as Arrow list arrays and the
    block is cut from their flat values, with no per-row Python objects.
    ``precision='float32'`` runs the forward pass in single precision (half
    the memory, about twice the matrix throughput; scores agree to ~1e-6
    relative); the default double precision is what the exact tests use.
    """
    if precision not in ("float64", "float32"):
        raise ValueError(f"precision must be float64 or float32, not {precision!r}")
    dtype = np.float32 if precision == "float32" else np.float64
    ship_package(spark)
    bc = broadcast_model(spark, model)
    width = dim or model.input_dim
    to_block = dense_block if kind == "dense" else token_block

    @F.arrow_udf(T.DoubleType())
    def _score(arr: pa.Array) -> pa.Array:
        e = _forward_errors(bc.value, row_blocks(arr, to_block, width), width, dtype)
        mask = pc.is_null(arr).to_numpy(zero_copy_only=False) if arr.null_count else None
        return pa.array(e, type=pa.float64(), mask=mask)

    # Declared non-deterministic only so the optimizer keeps it in one place:
    # otherwise a filter on the score (threshold, inferred not-null) is pushed
    # below the projection with the function inlined, and every row is scored
    # twice.  The score itself depends on the row alone.
    once = _score.asNondeterministic()

    def scorer(features) -> Column:
        return once(F.col(features) if isinstance(features, str) else features)

    return scorer


def recon_error(spark: SparkSession, model: Model, features, kind: str = "dense",
                dim: int | None = None, precision: str = "float64") -> Column:
    """Column with the reconstruction error of ``features`` (see make_scorer)."""
    return make_scorer(spark, model, kind, dim, precision)(features)


def dense_features(dim: int = EMBED_DIM):
    """Arrow UDF: token slots -> dense normalised array<double> (for callers
    that want explicit vectors; fitting uses sparse MLlib vectors)."""
    ship_package(SparkSession.active())

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def _dense(arr: pa.Array) -> pa.Array:
        block = token_block(arr, dim)
        offsets = np.arange(0, block.size + 1, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.ravel()))

    return _dense


def rank_one_model(dim: int, weight) -> Model:
    """Linear rank-1 autoencoder: z = x.w, x_hat = z w (no bias)."""
    w = np.array([weight(d) for d in range(dim)], dtype=np.float64)
    return Model([w.reshape(dim, 1), w.reshape(1, dim)], [np.zeros(1), np.zeros(dim)],
                 ["linear", "linear"])
