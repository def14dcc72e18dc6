"""M1 variant: learned token vectors with MLlib's Word2Vec.

``Word2VecModel.transform`` averages the vectors of a row's tokens, the same
pooling as the hashed embedding.  Training runs in MLlib (vocabulary and
vectors are bounded by ``vectorSize`` x vocabulary after ``minCount``).
"""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from logscan.functions.hashing import tokens


def fit_word2vec(lines: DataFrame, min_count: int, partitions: int, text: str = "Message", size: int = 64,
                 seed: int = 42, iterations: int = 1):
    """MLlib Word2Vec over the tokens of the masked messages.

    MLlib holds the vocabulary on the driver, so the caller states
    ``min_count``, which bounds it, and the partitions that train
    (per-partition updates, as MLlib documents).  Texts that carry durations
    have a vocabulary that grows with the data; masked messages do not."""
    w2v = Word2Vec(vectorSize=size, minCount=min_count, seed=seed, numPartitions=partitions,
                   maxIter=iterations, inputCol="_tokens", outputCol="_vec")
    return w2v.fit(lines.select(tokens(text).alias("_tokens")))


def word2vec_features(model, lines: DataFrame, text: str = "Message", name: str = "features") -> DataFrame:
    """Adds ``name`` as array<double>: the mean token vector of the text."""
    out = model.transform(lines.withColumn("_tokens", tokens(text)))
    return out.withColumn(name, vector_to_array("_vec")).drop("_tokens", "_vec")
