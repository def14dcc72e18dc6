import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from logscan.operators.autoencoder import AdamState, fit_autoencoder, local_epoch
from logscan.operators.pca import fit_pca
from logscan.operators.score import Model, recon_error
from logscan.operators.stats import threshold


def test_one_partition_equals_sequential_numpy(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    dims = (64, 16, 4, 16, 64)
    model, hist = fit_autoencoder(emb, "embedding", "vec_id", dims=dims, epochs=2, lr=1e-3,
                                  batch_size=32, partitions=1)
    # the same run by hand: rows in the per-epoch order of the job
    order = {}
    for e in (1, 2):
        uid = F.monotonically_increasing_id()  # the id the trainer assigns (one input split)
        rows = (emb.select("embedding", uid.alias("u"))
                .select("embedding", F.xxhash64(F.col("u"), F.lit(42), F.lit(e)).alias("h"), "u").collect())
        order[e] = [np.asarray(r.embedding, dtype=np.float64) for r in sorted(rows, key=lambda r: (r.h, r.u))]
    state = AdamState.fresh(Model.init(dims, seed=42))
    state = AdamState.from_flat(state.shapes, state.flat(), 0.0, dtype=np.float32)
    means = []
    for e in (1, 2):
        errs = np.concatenate(list(local_epoch(state, model.acts, iter([np.stack(order[e])]), 32, 1e-3)))
        means.append(errs.mean())
    assert [h[2] for h in hist] == pytest.approx(means, rel=1e-5)
    hand = state.model(model.acts)
    for w1, w2 in zip(hand.ws, model.ws):
        assert np.allclose(w1, w2, rtol=1e-5, atol=1e-7)


def test_loss_falls_with_mixing(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    _, hist = fit_autoencoder(emb, "embedding", "vec_id", dims=(64, 32, 8, 32, 64), epochs=4, lr=1e-3,
                              partitions=4)
    losses = [h[2] for h in hist]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    assert all(h[1] == 500 for h in hist)


def test_pca_outliers_rank_above_threshold(spark):
    rng = np.random.default_rng(0)
    basis = rng.normal(size=(3, 20))
    normal = rng.normal(size=(600, 3)) @ basis + 0.01 * rng.normal(size=(600, 20))
    outliers = 3 * rng.normal(size=(6, 20))
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(np.vstack([normal, outliers]))]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    model = fit_pca(df.where("id < 600"), "x", k=3)
    scored = df.select("id", recon_error(spark, model, "x").alias("recon_error"))
    thr = threshold(scored.where("id < 600"))
    flagged = {r.id for r in scored.where(F.col("recon_error") > thr).collect()}
    assert set(range(600, 606)) <= flagged


def test_two_level_mixing_equals_plain_sum(spark):
    from logscan.operators.autoencoder import mix

    rows = [(1, p, c, 10 + p, float("nan"), [float(p), float(c), 1.0]) for p in range(300) for c in range(3)]
    params = spark.createDataFrame(rows, "kind int, part int, chunk int, n long, err double, vals array<double>")
    got = {r.chunk: (r.n, list(r.vals)) for r in mix(params, 300).collect()}
    n_total = sum(10 + p for p in range(300))
    for c in range(3):
        assert got[c][0] == n_total
        assert got[c][1] == [float(sum(range(300))), float(c * 300), 300.0]


def test_rounds_per_epoch(spark):
    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    _, hist = fit_autoencoder(emb, "embedding", dims=(64, 16, 64), epochs=3, lr=1e-3, partitions=4, rounds=3)
    assert [h[1] for h in hist] == [500, 500, 500]
    losses = [h[2] for h in hist]
    assert losses[0] > losses[1] > losses[2]


def test_hot_duplicate_group_is_spread(spark):
    from logscan.operators.autoencoder import training_layout

    hot = spark.range(3000).select(F.array(*[F.lit(1.0)] * 8).alias("x"))           # one line, 3000 copies
    rest = spark.range(6000).select(F.array(*[F.col("id").cast("double")] * 8).alias("x"))
    data, n = training_layout(hot.unionByName(rest), "x", partitions=8)
    sizes = [r["c"] for r in data.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).collect()]
    assert n == 8 and len(sizes) == 8 and sum(sizes) == 9000
    assert max(sizes) < 1.3 * (9000 / 8)  # no partition holds the hot group


def test_pca_equals_numpy_brute_force(spark):
    """M2b against a direct numpy PCA of the same token vectors (small fixture)."""
    from logscan.functions.hashing import token_indices, token_vectors
    from logscan.operators import prepare as P
    from logscan.plans.queries import logs_view
    from conftest import SF_SMALL

    lines = P.scorable_lines(logs_view(spark, SF_SMALL)).withColumn("slots", token_indices("text"))
    k = 8
    model = fit_pca(token_vectors(lines.select("slots"), "slots", 768), "features", k=k)
    got = lines.select("slots", recon_error(spark, model, "slots", kind="tokens", dim=768).alias("e")).collect()
    x = np.zeros((len(got), 768))
    for i, r in enumerate(got):
        np.add.at(x[i], r.slots, 1.0)
        x[i] /= np.linalg.norm(x[i])
    mu = x.mean(axis=0)
    vals, vecs = np.linalg.eigh(np.cov(x - mu, rowvar=False))
    order = np.argsort(vals)[::-1]
    assert vals[order[k - 1]] - vals[order[k]] > 1e-6  # a clear eigengap: the subspace is unique
    p = vecs[:, order[:k]]
    c = x - mu
    want = ((c - c @ p @ p.T) ** 2).mean(axis=1)
    assert np.allclose([r.e for r in got], want, rtol=1e-6, atol=1e-12)


def _sequential(rows, dims, epochs, lr, batch_size, seed):
    """Adam over the same minibatches in plain numpy; rows: (features, step per epoch)."""
    from logscan.operators.autoencoder import adam_step

    model = Model.init(dims, seed=seed)
    state = AdamState.fresh(model)
    means = []
    for e in range(epochs):
        errs = []
        for step in range(-(-len(rows) // batch_size)):
            x = np.array([r[0] for r in rows if r[1][e] == step])
            if len(x):
                errs.append(adam_step(state, model.acts, x, lr))
        means.append(np.concatenate(errs).mean())
    return state.model(model.acts), means


def test_synchronous_training_for_any_partitions(spark):
    from logscan.operators.sync_training import fit_synchronous, step_of

    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    dims, n_steps = (64, 16, 4, 16, 64), -(-500 // 128)
    uid = F.monotonically_increasing_id()
    steps = emb.select("embedding", *[step_of(uid, 42, e, n_steps).alias(f"s{e}") for e in (1, 2)]).collect()
    hand, means = _sequential([(np.asarray(r.embedding, dtype=np.float64), (r.s1, r.s2)) for r in steps],
                              dims, 2, 1e-3, 128, 42)
    for parts in (1, 4, 7):
        model, hist = fit_synchronous(emb, "embedding", dims=dims, epochs=2, lr=1e-3, batch_size=128, partitions=parts)
        for a, b in zip([*hand.ws, *hand.bs], [*model.ws, *model.bs]):
            assert np.allclose(a, b, rtol=0, atol=1e-6)
        assert [h[2] for h in hist] == pytest.approx(means, rel=1e-9) and [h[1] for h in hist] == [500, 500]
    with pytest.raises(ValueError):
        fit_synchronous(emb, "embedding", dims=(64, 1 << 17, 64), partitions=4)
    assert fit_synchronous(emb.limit(0), "embedding", dims=(64, 8, 64), partitions=2)[1] == []


def test_moments_without_gradients_vanish():
    """Subnormal moments make every later step slower; weights are as by the plain formula."""
    from logscan.operators.autoencoder import ADAM_RUN, BETA1, BETA2, EPS, apply_gradients

    rng = np.random.default_rng(1)
    p = rng.normal(size=(ADAM_RUN // 100, 130)).astype(np.float32)  # more than one run
    state = AdamState([p.copy()], [np.zeros_like(p)], [np.zeros_like(p)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, 1201):
        g = (rng.normal(size=p.shape) * 1e-6 * (t < 3)).astype(np.float32)
        m = m * BETA1 + (1 - BETA1) * g
        v = v * BETA2 + g * g * (1 - BETA2)
        p -= m / (np.sqrt(v) / np.sqrt(1 - BETA2 ** t) + EPS).astype(np.float32) * (1e-3 / (1 - BETA1 ** t))
        apply_gradients(state, [g], 1e-3)
    tiny = np.finfo(np.float32).tiny
    assert ((m != 0) & (np.abs(m) < tiny)).any()
    for a in (*state.m, *state.v):
        assert not ((a != 0) & (np.abs(a) < tiny)).any()
    assert np.allclose(state.params[0], p, rtol=0, atol=1e-6)


def test_synchronous_steps_take_no_second_each(spark):
    import time

    from logscan.operators.sync_training import fit_synchronous

    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(rng.normal(size=4).tolist(),) for _ in range(600)], "v array<double>")
    start = time.time()
    _, hist = fit_synchronous(df, "v", dims=(4, 2, 4), epochs=1, batch_size=4, partitions=2)  # 150 steps, 3 windows
    assert time.time() - start < 100 and hist[0][:2] == (1, 600)


def test_sums_that_grow_equal_a_full_fit(spark, tmp):
    from logscan.operators.gram import add_rows, fit_pca_sums, read_sums

    emb = spark.read.parquet(f"{SF_MID}/embeddings.parquet").withColumn(
        "embedding", F.when(F.col("vec_id") != 7, F.col("embedding")))  # one row without features
    x = np.array([r.embedding for r in emb.collect() if r.embedding is not None], dtype=np.float64)
    with pytest.raises(ValueError):
        fit_pca_sums(spark, tmp, 64)
    for batch in range(6):
        add_rows(emb.where(F.col("vec_id") % 6 == batch).repartition(3), "embedding", 64, tmp, batch)
        if batch % 2:
            add_rows(emb.where(F.col("vec_id") % 6 == batch), "embedding", 64, tmp, batch)  # again
    n, sums, gram = read_sums(spark, tmp, 64)
    assert n == len(x) == 499 and np.allclose(sums, x.sum(axis=0)) and np.allclose(gram, x.T @ x)
    model, full = fit_pca_sums(spark, tmp, 64, k=5), fit_pca(emb.where("embedding IS NOT NULL"), "embedding", k=5)
    assert np.allclose(model.errors(x), full.errors(x), rtol=1e-9, atol=1e-12)
    add_rows(emb.limit(0), "embedding", 64, tmp, 6)  # an empty batch adds nothing
    assert read_sums(spark, tmp, 64)[0] == 499


def test_token_sums(spark, tmp):
    from logscan.operators.gram import add_rows, read_sums

    df = spark.createDataFrame([([0, 0, 2],), ([1],), ([],)], "slots array<int>")
    add_rows(df, "slots", 3, tmp, 0, kind="tokens")
    n, sums, gram = read_sums(spark, tmp, 3)
    x = np.array([[2, 0, 1], [0, 1, 0], [0, 0, 0]]) / np.array([[5**0.5], [1], [1]])
    assert n == 3 and np.allclose(sums, x.sum(axis=0)) and np.allclose(gram, x.T @ x)
