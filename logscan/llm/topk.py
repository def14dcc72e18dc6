"""Operator 6: exact top-k inner products, norm-sorted and bounded.

Vectors are range-partitioned by descending length into stripes and met in
rounds, the longest stripe first and then each time three times as many as
before.  A query takes part in a round only while its length times the round's
largest length reaches its k-th best score so far.  Queries come in blocks;
every (stripe, block) pair is one bounded search.  Inside a stripe, vectors
come in blocks of descending length, rotated by the right singular vectors of
the stripe, so that the first coordinates carry most of every product.
Products are summed a few rotated columns at a time; after each step a pair
stays only while its partial sum plus the product of the two residual lengths
(Cauchy-Schwarz) reaches the query's k-th best score.  Pairs that outlive all
columns are scored exactly on the integer components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscan.llm.common import Scratch, read_table
from logscan.session import ship_package

TOP = 20
QUERY_EVERY = 20
MIN_STRIPES = 32
GROWTH = 4             # a round brings the rows met so far to this many times as many
STRIPE_ROWS = 16_384
QUERY_ROWS = 4096
BLOCK = 512            # vectors per tile
COLUMNS = 8            # rotated columns added between two bounds
SCALE = 64.0
LONG = (1 << 63) - 1


def _integers(batches):
    """(vec_id, dim, v: float64 integers, norm) of rows that take part."""
    for batch in batches:
        ids, lists = batch.column("vec_id"), batch.column("embedding")
        keep, dims, vs, norms = [], [], [], []
        for r in range(batch.num_rows):
            if not ids[r].is_valid or not lists[r].is_valid or lists[r].values.null_count:
                continue
            v = np.floor(SCALE * lists[r].values.to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0
            if np.isfinite(v).all():
                keep.append(r)
                dims.append(len(v))
                vs.append(v.tobytes())
                norms.append(float(np.sqrt(np.square(v).sum())))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(keep, type=pa.int64())).cast(pa.int64()), pa.array(dims, type=pa.int32()),
             pa.array(vs, type=pa.binary()), pa.array(norms, type=pa.float64())], ["vec_id", "dim", "v", "norm"])


def _matrix(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype=np.float64).reshape(len(col), dim)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired integer rows: float64 where every partial sum
    stays below 2^53, else whole numbers, held to the range of a long."""
    if not a.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    out = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a.tolist(), b.tolist())]
    return np.array([max(-LONG - 1, min(LONG, s)) for s in out], dtype=np.int64)


def _best(q, score, ids, k: int):
    """The k best (score, then smaller id) of each query number."""
    order = np.lexsort((ids, -score.astype(object) if len(score) and score.min() == -LONG - 1 else -score, q))
    q = q[order]
    first = np.searchsorted(q, q)
    top = np.arange(len(q)) - first < k
    return q[top], score[order][top], ids[order][top]


def _survivors(q_rot, v_rot, q_rest, v_rest, least, slack, stats=None):
    """Pairs (query, vector) of a tile whose product may reach ``least``: the
    rotated columns are added step by step, every step bounded anew.  While
    most pairs live, their sums grow as one matrix, then pair by pair."""
    dim, cut = q_rot.shape[1], least - slack
    sums = np.zeros((len(q_rot), len(v_rot)))
    r = c = part = None
    for at in range(0, dim, COLUMNS):
        to = min(dim, at + COLUMNS)
        if stats is not None:
            stats[at] = stats.get(at, 0) + (sums.size if r is None else len(r))
        if r is None:
            sums += q_rot[:, at:to] @ v_rot[:, at:to].T
            may = sums + q_rest[:, to, None] * v_rest[None, :, to] >= cut[:, None]
            if np.count_nonzero(may) * 2 <= may.size:
                r, c = np.nonzero(may)
                part = sums[r, c]
        else:
            part += np.einsum("ij,ij->i", q_rot[r, at:to], v_rot[c, at:to])
            may = part + q_rest[r, to] * v_rest[c, to] >= cut[r]
            r, c, part = r[may], c[may], part[may]
    return np.nonzero(may) if r is None else (r, c)


def _residuals(rot: np.ndarray) -> np.ndarray:
    """Lengths of the rows from each column on; 0 after the last one."""
    left = np.cumsum(np.square(rot[:, ::-1]), axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([left, np.zeros((len(rot), 1))], axis=1))


def search(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray,
           floor: np.ndarray, k: int = TOP, stats: dict | None = None):
    """(query number, score, id): every vector that may be among a query's k
    best, given that ``floor`` (its k-th score elsewhere) must be reached; a
    row never meets itself.  ``stats`` counts the pairs that enter each step."""
    got = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    if not vectors.size or not queries.size:
        return got
    # in units of the largest components: no sum of squares overflows
    v_unit, q_unit = max(1.0, np.abs(vectors).max()), max(1.0, np.abs(queries).max())
    scaled = vectors / v_unit
    order = np.argsort(-np.square(scaled).sum(axis=1), kind="stable")
    vectors, scaled, ids, rows = vectors[order], scaled[order], ids[order], rows[order]
    _, axes = np.linalg.eigh(scaled.T @ scaled)  # right singular vectors, smallest first
    axes = axes[:, ::-1]
    v_rot, q_rot = scaled @ axes, (queries / q_unit) @ axes
    v_rest, q_rest = _residuals(v_rot), _residuals(q_rot)
    norms, q_norms = v_rest[:, 0], q_rest[:, 0]
    least = floor.astype(np.float64).copy()
    for at in range(0, len(ids), BLOCK):
        block = slice(at, at + BLOCK)
        slack = 1e-6 / (v_unit * q_unit) + 1e-9 * q_norms * norms[at]  # covers rounding of the rotated sums
        reach = least / v_unit / q_unit
        live = np.flatnonzero(q_norms * norms[at] + slack >= reach)
        if not len(live):
            break
        r, c = _survivors(q_rot[live], v_rot[block], q_rest[live], v_rest[block], reach[live], slack[live], stats)
        r, c = live[r], at + c
        own = query_rows[r] == rows[c]
        r, c = r[~own], c[~own]
        parts = [exact_products(queries[r[i:i + 65536]], vectors[c[i:i + 65536]]) for i in range(0, len(r), 65536)]
        score = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        keep = score >= least[r]
        got = _best(np.concatenate([got[0], r[keep]]), np.concatenate([got[1], score[keep]]),
                    np.concatenate([got[2], ids[c[keep]]]), k)
        count = np.bincount(got[0], minlength=len(queries))
        full = np.flatnonzero(count >= k)
        last = np.searchsorted(got[0], full, side="right") - 1
        least[full] = np.maximum(least[full], got[1][last])
    return got


def top_products(vectors: DataFrame, k: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of
    each row whose vec_id is divisible by ``every``, ties to smaller ids.

    Rows with a null id, or a vector that is null or holds null or non-finite
    components, take no part.  Every row is a candidate of every query row but
    itself: repeated rows are candidates of their own, and query rows that
    share an id have a list each.  Only vectors of one length meet, empty ones
    never.  A score beyond the range of a long is held at its end.  Fewer than
    k candidates give shorter lists, an empty table none.  Other columns of
    the input, whatever their names, are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "topk")
    taken = scratch.save(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
                         .mapInArrow(_integers, "vec_id long, dim int, v binary, norm double").where("dim > 0"),
                         "taken")
    n = taken.count()
    stripes = max(MIN_STRIPES, -(-n // STRIPE_ROWS))
    blocks = max(1, -(-n // (every * QUERY_ROWS)))
    # ids and stripes are fixed by the write: a partition is a stripe
    rows = scratch.save(
        taken.repartitionByRange(stripes, F.desc("norm"), F.xxhash64("vec_id", "v"))
        .select("*", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("stripe")), "rows")
    queries = scratch.save(
        rows.where(F.col("vec_id") % every == 0)
        .select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "dim", F.col("v").alias("q"),
                F.col("norm").alias("q_norm"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")),
        "queries")

    def meet(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(v) or not len(q):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        dim = int(v["dim"].iloc[0])
        number, score, vid = search(_matrix(list(v["v"]), dim), v["vec_id"].to_numpy(), v["row"].to_numpy(),
                                    _matrix(list(q["q"]), dim), q["query_row"].to_numpy(), q["floor"].to_numpy(), k)
        return pd.DataFrame({"query_row": q["query_row"].to_numpy()[number],
                             "query_id": q["query_id"].to_numpy()[number], "vec_id": vid, "score": score})

    key, schema = ("stripe", "block", "dim"), "query_row long, query_id long, vec_id long, score long"
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    best = spark.createDataFrame([], schema + ", rank int")
    lo, step = 0, 0
    while lo < stripes:
        hi = min(stripes, max(1, GROWTH * lo))
        longest = rows.where(F.col("stripe") >= lo).agg(F.max("norm")).first()[0]
        if longest is None:  # the remaining stripes are empty
            break
        # the k-th best score so far, of queries that have as many
        floors = best.where(F.col("rank") == k).select("query_row", F.col("score").cast("double").alias("floor"))
        low = F.coalesce("floor", F.lit(float("-inf")))
        right = (queries.join(floors, "query_row", "left").withColumn("floor", low)
                 .where(F.col("q_norm") * longest * (1 + 1e-9) + 1e-6 >= F.col("floor"))
                 .withColumn("stripe", F.explode(F.sequence(F.lit(lo), F.lit(hi - 1)))).drop("q_norm"))
        left = (rows.where(F.col("stripe").between(lo, hi - 1)).drop("norm")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
        found = (left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, schema))
        best = scratch.save(best.drop("rank").unionAll(found).withColumn("rank", F.row_number().over(order))
                            .where(F.col("rank") <= k), f"best{step}")
        lo, step = hi, step + 1
    return best.select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 20 of every 20th embedding."""
    return top_products(read_table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.n <> q.n WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""
