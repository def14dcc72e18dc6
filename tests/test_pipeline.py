from pyspark.sql import functions as F

from conftest import SF_SMALL
from logscan.functions.word2vec import fit_word2vec, word2vec_features
from logscan.operators import prepare as P
from logscan.operators.join import attach_scores
from logscan.operators.score import recon_error
from logscan.operators.pca import fit_pca
from logscan.plans.fit import fit
from logscan.plans.queries import logs_view


def test_attach_scores_drops_unscored(spark):
    logs = P.with_row_id(P.prepare(logs_view(spark, SF_SMALL, dirty=True)))
    scores = P.drop_incomplete(logs).select("row_id", F.lit(0.5).alias("recon_error"))
    out = attach_scores(logs, scores)
    assert out.columns[0] == "row_id" and out.columns[-1] == "recon_error"
    assert out.count() == scores.count() < logs.count()


def test_fit_random_split_and_pca(spark):
    res = fit(logs_view(spark, SF_SMALL), method="pca", k=8, split="random")
    assert res.threshold > 0
    assert res.model.input_dim == 768 and res.model.meta["features"] == "tokens"
    s = res.summary.first()
    assert s.min_error <= s.p90 <= s.p95 <= s.p99 <= s.max_error
    assert res.test_anomalies.count() > 0


def test_word2vec_variant(spark):
    lines = P.scorable_lines(logs_view(spark, SF_SMALL))
    model = fit_word2vec(lines, min_count=1, partitions=2, size=16)
    feats = word2vec_features(model, lines)
    pca = fit_pca(feats, "features", k=4)
    scored = feats.select(recon_error(spark, pca, "features").alias("e"))
    assert scored.where(F.col("e").isNull()).count() == 0 and scored.count() == lines.count()


def test_fit_on_nothing(spark):
    from logscan.schema import LOG_SCHEMA

    import pytest

    with pytest.raises(ValueError, match="no complete log line"):
        fit(spark.createDataFrame([], LOG_SCHEMA), method="pca", k=4)
