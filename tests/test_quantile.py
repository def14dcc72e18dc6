import numpy as np
import pytest

from logscan.operators.quantile import exact_quantiles, key_to_double
from logscan.operators.stats import error_summary, threshold


@pytest.mark.parametrize("seed", [0, 1])
def test_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.lognormal(-7, 1.5, 3000), rng.normal(0, 1, 500), [0.0, -0.0, 5.0, 5.0, 5.0]])
    df = spark.createDataFrame([(float(v),) for v in vals], "e double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.9, 0.95, 0.99, 1.0]
    (g, n, got), = exact_quantiles(df, "e", probs)
    assert n == len(vals)
    for p in probs:
        assert got[p] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-15, abs=0)


def test_ties_and_small(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "e double")
    assert threshold(df, "e") == pytest.approx(3.85, rel=1e-15)
    one = spark.createDataFrame([(7.0,)], "e double")
    assert threshold(one, "e") == 7.0
    empty = spark.createDataFrame([], "e double")
    assert threshold(empty, "e") is None
    same = spark.createDataFrame([(0.25,)] * 1000 + [(None,)], "e double")
    assert threshold(same, "e") == 0.25


def test_hot_value_and_groups(spark):
    # a third of all rows share one value; groups are handled together
    rng = np.random.default_rng(3)
    a = np.concatenate([np.full(2000, 0.001), rng.uniform(0, 1, 4000)])
    b = rng.uniform(-5, 5, 999)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b]
    df = spark.createDataFrame(rows, "g string, e double").repartition(7)
    res = {g[0]: (n, q) for g, n, q in exact_quantiles(df, "e", [0.5, 0.95], by=["g"])}
    assert res["a"][0] == 6000 and res["b"][0] == 999
    for key, arr in (("a", a), ("b", b)):
        for p in (0.5, 0.95):
            assert res[key][1][p] == pytest.approx(float(np.percentile(arr, p * 100)), rel=1e-15)


def test_approx_opt_in(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 1001)], "e double")
    assert threshold(df, "e") == pytest.approx(950.05)
    assert abs(threshold(df, "e", approx_accuracy=10000) - 950.05) <= 1.0


def test_summary_of_nothing(spark):
    r = error_summary(spark.createDataFrame([], "recon_error double")).collect()
    assert len(r) == 1 and r[0].n == 0 and r[0].p95 is None


def test_summary(spark):
    vals = np.linspace(0, 1, 101)
    df = spark.createDataFrame([(float(v),) for v in vals], "recon_error double")
    r = error_summary(df).first()
    assert r.n == 101 and r.min_error == 0.0 and r.max_error == 1.0
    assert r.p90 == pytest.approx(0.9) and r.p99 == pytest.approx(0.99)


def test_key_roundtrip():
    import pandas as pd
    from logscan.operators import quantile as q
    vals = np.array([-1e300, -2.5, -0.0, 0.0, 1e-310, 3.0, 1e300])
    bits = vals.view(np.int64)
    keys = np.where(bits < 0, ~bits, bits | q._SIGN)
    order = np.argsort(keys.view(np.uint64), kind="stable")
    assert list(vals[order]) == sorted(vals)
    assert [key_to_double(int(k)) for k in keys][-1] == 1e300


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300),
                          st.sampled_from([0.0, -0.0, 1.0, 1e-310, 5e-324])), min_size=1, max_size=300),
       st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=1, max_size=4))
def test_property_against_numpy(spark, vals, probs):
    df = spark.createDataFrame([(float(v),) for v in vals], "e double")
    (_, n, got), = exact_quantiles(df, "e", probs)
    assert n == len(vals)
    arr = np.array(vals, dtype=np.float64)
    for p in probs:
        want = float(np.percentile(arr, p * 100))
        assert got[float(p)] == pytest.approx(want, rel=1e-12, abs=1e-300) or (
            np.isinf(want) and got[float(p)] == want)


def test_many_groups(spark):
    df = spark.range(15_000).selectExpr("id % 3000 as g", "cast(id as double) as recon_error")
    rows = {r.g: r for r in error_summary(df, by=["g"]).collect()}
    assert len(rows) == 3000
    for g in (0, 17, 2999):
        vals = np.arange(g, 15_000, 3000, dtype=float)
        assert (rows[g].n, rows[g].min_error, rows[g].max_error) == (5, vals[0], vals[-1])
        assert rows[g].p90 == pytest.approx(np.percentile(vals, 90), rel=1e-15)


def test_hundred_thousand_groups_and_a_hot_one(spark, monkeypatch):
    import pandas as pd
    from logscan.operators import quantile

    # a third of all rows in group 0, half of them one value; nulls and NaN beside
    df = spark.range(450_000).selectExpr(
        "if(id % 3 = 0, 0, if(id = 1, null, id % 100003)) as g",
        "if(id % 6 = 0, 1.5, if(id = 100004, double('NaN'), if(id = 7, null, cast((id * 7919) % 10007 as double)))) as e")
    pdf = df.toPandas().dropna(subset=["e"])  # drops NaN too: that group is checked apart
    want = pdf.groupby("g", dropna=False).e
    n, top, q = want.size(), want.max(), want.quantile([0.0, 0.5, 0.95])
    for bound in (quantile.MAX_BROADCAST_PICKS, 10):
        monkeypatch.setattr(quantile, "MAX_BROADCAST_PICKS", bound)
        got = quantile.grouped_quantiles(df, "e", [0.0, 0.5, 0.95], ["g"]).toPandas().set_index("g")
        nan = df.where("isnan(e)").first().g
        assert len(got) == len(n) + (nan not in n.index) and len(got) > 100_000
        same = got.drop(index=nan)
        for i, p in enumerate((0.0, 0.5, 0.95)):
            ref = q.xs(p, level=1) if p in q.index.levels[1] else None
            both = pd.concat([same[f"q{i}"].sort_index(), ref.drop(index=nan, errors="ignore").sort_index()], axis=1).dropna()
            assert len(both) >= len(same) - 1 and np.allclose(both.iloc[:, 0], both.iloc[:, 1], rtol=1e-12)
        assert (same.n.loc[0.0], same._max.loc[0.0]) == (n.loc[0.0], top.loc[0.0])
        assert np.isnan(got._max.loc[nan])


def test_grouped_values_shuffle_once(spark):
    import re
    from logscan.operators.quantile import grouped_quantiles

    df = spark.range(1000).selectExpr("id % 7 as g", "cast(id as double) as e")
    plan = grouped_quantiles(df, "e", [0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    # behind the one range exchange (already checkpointed) only group-sized rows move
    assert not re.search(r"Exchange \S+partitioning\([^)]*_v", plan) and "rangepartitioning" not in plan
