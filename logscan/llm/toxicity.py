"""Operator 9: toxicity by character n-grams scaled by naive Bayes log-count ratios.

A text's features are its distinct character 3-, 4- and 5-grams, hashed.
Over labelled rows, each feature's log-count ratio r compares how often it
occurs in toxic and in other texts; a logistic regression is then fitted on
the features scaled by r (presence times r), so that the linear weights start
from naive Bayes evidence.

Fit: at most ``MAX_FIT_ROWS`` labelled rows (the smallest id hashes), the
documented bound of the classifier's sample.  Counting, selection of the
``MAX_FEATURES`` most associated features and feature extraction run on
Spark; the driver fits one weight per selected feature.  Scoring reads whole
texts in Arrow batches against the broadcast weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import read_table, release_memory, released, text_slices
from logscan.session import ship_package

SIZES = (3, 4, 5)
BUCKETS_LOG2 = 22
MAX_FIT_ROWS = 20_000
SLICE_BYTES = 1 << 17  # of text whose n-grams a worker holds at a time: some 130 bytes of arrays each
MAX_FEATURES = 4096
MIN_TEXTS = 3        # labelled texts that must hold a feature
SMOOTHING = 1.0
L2 = 1e-4
STEPS = 200
HELD_OUT_MOD = 5

_SPACES = np.array([0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint32)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


def ngram_buckets(data: np.ndarray, offsets: np.ndarray):
    """(text number, bucket) arrays of all character n-grams, one pair of
    arrays per n-gram size.  A-Z are lower-cased, white space is one kind of
    blank, and each text stands between blanks."""
    lead = (data & 0xC0) != 0x80
    firsts = np.concatenate([[0], np.cumsum(lead)])[offsets]  # characters before each text
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).copy()
    codes[(codes >= 0x41) & (codes <= 0x5A)] += 32
    codes[np.isin(codes, _SPACES)] = 0x20
    n_docs = len(offsets) - 1
    padded = np.full(len(codes) + 2 * n_docs, 0x20, dtype=np.uint32)
    doc = np.repeat(np.arange(n_docs), np.diff(firsts))
    padded[np.arange(len(codes)) + 2 * doc + 1] = codes
    owner = np.repeat(np.arange(n_docs), np.diff(firsts) + 2)
    h = np.zeros(len(padded), dtype=np.uint32)
    for n in range(1, max(SIZES) + 1):
        k = len(padded) - n + 1
        if k <= 0:
            return
        h = h[:k] + (padded[n - 1:] ^ np.uint32(n)) * _FACTORS[n - 1]
        if n in SIZES:
            x = h ^ (h >> np.uint32(15))
            x = (x * np.uint32(0x2C1B3C6D)) ^ np.uint32(n * 0x01000193)
            x = (x ^ (x >> np.uint32(13))) * np.uint32(0x297A2D39)
            same = owner[:k] == owner[n - 1:]
            yield owner[:k][same], (x >> np.uint32(32 - BUCKETS_LOG2))[same]


def distinct_features(data, offsets, table: np.ndarray | None = None):
    """Sorted distinct (text, feature) pairs as text * 2^BUCKETS_LOG2 + feature;
    ``table`` maps buckets to feature numbers plus one (0: not a feature)."""
    keys = []
    for doc, bucket in ngram_buckets(data, offsets):
        if table is not None:
            number = table[bucket]
            at = np.flatnonzero(number)
            doc, bucket = doc[at], number[at].astype(np.int64) - 1
        keys.append((doc.astype(np.int64) << BUCKETS_LOG2) | bucket)
    return np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)


_MASK = (1 << BUCKETS_LOG2) - 1


def _count_partition(batches):
    """Texts per bucket and class of one partition: (bucket, toxic, other)."""
    counts = None
    for batch in batches:
        y = batch.column("y").to_numpy(zero_copy_only=False)
        for first, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            if counts is None:
                counts = np.zeros((2, 1 << BUCKETS_LOG2), dtype=np.int32)
            keys = distinct_features(data, offsets)
            toxic = y[first + (keys >> BUCKETS_LOG2)] == 1
            for c, side in ((1, keys[toxic]), (0, keys[~toxic])):
                np.add.at(counts[c], side & _MASK, 1)  # in place: a slice makes no array of all buckets
    if counts is None:
        return
    at = np.flatnonzero(counts[0] | counts[1])
    for i in range(0, len(at), 1 << 16):
        b = at[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.astype(np.int32)), pa.array(counts[1][b]), pa.array(counts[0][b])], ["b", "toxic", "other"])


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(text, y) of the labelled rows used to fit.  Rows whose id hash is held
    out, or whose label is null, take no part; several labels of one id count
    as toxic if any is."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # at most max_rows pairs of 12 bytes: a proven bound
    return docs.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("text", "y")


def held_out(id_col: str, mod: int = HELD_OUT_MOD) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == 0, F.lit(False))


class Model:
    """Buckets, their log-count ratios and weights, and the intercept."""

    def __init__(self, buckets, ratios, weights, bias):
        self.buckets, self.ratios, self.weights, self.bias = buckets, ratios, weights, float(bias)

    def table(self) -> np.ndarray:
        t = np.zeros(1 << BUCKETS_LOG2, dtype=np.uint16)
        t[self.buckets] = np.arange(1, len(self.buckets) + 1)
        return t


def _fit_weights(rows, cols, y, ratios, l2: float = L2, steps: int = STEPS):
    """Logistic regression on presence times ratio (full batch, Adam)."""
    n, k = len(y), len(ratios)
    w = np.zeros(k + 1)
    rate = (y.sum() + 1.0) / (n + 2.0)
    w[k] = np.log(rate / (1 - rate))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=(w[:k] * ratios)[cols], minlength=n) + w[k]
        err = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y
        g = np.empty(k + 1)
        g[:k] = np.bincount(cols, weights=err[rows], minlength=k) * ratios / n + l2 * w[:k]
        g[k] = err.mean()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return w[:k], w[k]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Fit on labelled rows of ``docs`` (columns doc_id, text).  Without rows of
    both classes the model has no features and scores everything alike."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = labelled_sample(docs.select("doc_id", "text"), labels, max_rows)
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)
    bias = np.log((pos + 1.0) / (neg + 1.0))
    if not pos or not neg:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0), bias)
    counts = (sample.mapInArrow(released(_count_partition), "b int, toxic int, other int")
              .groupBy("b").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    # association of presence and label (chi-square of the 2 x 2 table)
    a, b = F.col("toxic").cast("double"), F.col("other").cast("double")
    c, d, n = F.lit(float(pos)) - a, F.lit(float(neg)) - b, float(pos + neg)
    chi = F.lit(n) * F.pow(a * d - b * c, 2) / F.greatest((a + b) * (c + d) * F.lit(float(pos) * neg), F.lit(1e-9))
    best = (counts.where((F.col("toxic") + F.col("other") >= MIN_TEXTS) & (c + d > 0))
            .select("b", "toxic", "other", chi.alias("chi")).orderBy(F.desc("chi"), "b").limit(max_features).collect())
    best.sort(key=lambda r: r["b"])
    buckets = np.array([r["b"] for r in best], dtype=np.int64)
    p = np.array([r["toxic"] for r in best]) + SMOOTHING
    q = np.array([r["other"] for r in best]) + SMOOTHING
    ratios = np.log(p / (pos + 2 * SMOOTHING)) - np.log(q / (neg + 2 * SMOOTHING))
    if not len(buckets):
        return Model(buckets, ratios, np.zeros(0), bias)
    bc = spark.sparkContext.broadcast(Model(buckets, ratios, ratios, 0).table())

    def features(batches):
        for batch in batches:
            ys = batch.column("y").to_numpy(zero_copy_only=False)
            for first, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                keys = distinct_features(data, offsets, bc.value)
                doc, number = keys >> BUCKETS_LOG2, (keys & _MASK).astype(np.uint16)
                cuts = np.searchsorted(doc, np.arange(len(offsets)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ys[first:first + len(offsets) - 1], type=pa.int32()),
                     pa.array([number[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], type=pa.binary())],
                    ["y", "f"])

    # at most max_rows rows of at most 2 * max_features bytes
    rows = sample.mapInArrow(released(features), "y int, f binary").toArrow()
    lists = [np.frombuffer(x, dtype=np.uint16) for x in rows.column("f").to_pylist()]
    y = (rows.column("y").to_numpy() == 1).astype(np.float64)
    order = sorted(range(len(y)), key=lambda i: (y[i], lists[i].tobytes()))  # fixed order of summation
    lists, y = [lists[i] for i in order], y[order]
    weights, bias = _fit_weights(np.repeat(np.arange(len(y)), [len(x) for x in lists]),
                                 np.concatenate(lists).astype(np.int64), y, ratios)
    return Model(buckets, ratios, weights, bias)


def scorer(spark: SparkSession, model: Model):
    """A text column -> probability of the label toxic (null counts as empty)."""
    ship_package(spark)
    bc = spark.sparkContext.broadcast((model.table(), model.weights * model.ratios, model.bias))

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        table, effect, bias = bc.value
        z = np.full(len(texts), bias)
        for first, data, offsets in text_slices(texts, SLICE_BYTES):
            keys = distinct_features(data, offsets, table)
            if len(keys):
                z[first:first + len(offsets) - 1] += np.bincount(
                    keys >> BUCKETS_LOG2, weights=effect[keys & _MASK], minlength=len(offsets) - 1)
        release_memory()
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))

    return score.asNondeterministic()  # keeps the scoring in one place of the plan


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` with held_out, score and predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without features; a null id
    is not held out; repeated rows score alike; an empty table gives no rows.
    Input columns of those names are replaced.
    """
    model = fit(docs, labels, **options)
    kept = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], held_out("doc_id").alias("held_out"),
                      scorer(docs.sparkSession, model)(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    out = score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                          read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")
