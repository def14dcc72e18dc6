"""A linear autoencoder fitted as PCA with MLlib.

The optimum of a linear autoencoder with a k-wide bottleneck spans the top
k principal components, so PCA is the closed-form, repeatable model.  The
covariance is a distributed tree aggregate inside MLlib; only the d x d
matrix reaches the driver.  MLlib's PCA does not centre in ``transform``, so
the mean is folded into the layer biases:
    z = (x - mu) P = x P - mu P,   x_hat = z P^T + mu
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscan.operators.score import Model


def fit_pca(df: DataFrame, features: str, k: int = 64) -> Model:
    """Fit on an array<float|double> or MLlib vector column (dense or
    sparse); returns a two-layer linear Model.

    MLlib makes several passes (mean, Gramian); the vectors are persisted
    for the duration of the fit so their features are computed once.
    """
    col = F.col(features)
    if not isinstance(df.schema[features].dataType, VectorUDT):
        col = array_to_vector(col)
    vec = df.select(col.alias("_v")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mu = np.asarray(vec.select(Summarizer.mean(F.col("_v")).alias("m")).first()["m"].toArray())
        d = mu.size
        k = min(k, d)
        pc = PCA(k=k, inputCol="_v", outputCol="_z").fit(vec).pc.toArray()  # (d, k)
    finally:
        vec.unpersist()
    return Model([pc, pc.T.copy()], [-(mu @ pc), mu], ["linear", "linear"],
                 meta={"kind": "pca", "k": k, "dim": d})
