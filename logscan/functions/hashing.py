"""Hash-based column expressions: token buckets (M1) and split buckets (M4).

Both use the first 32 bits of an md5 digest, so the same numbers come out of
any engine with md5 and hex parsing, and they do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value (as in the reference): embedding width, 768.
EMBED_DIM = 768
# Design value: characters that separate tokens.
TOKEN_SEPARATORS = r"[ \t\r\n]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_bucket(value, buckets: int) -> Column:
    """0..buckets-1 from the leading 32 bits of md5(value as text)."""
    h = F.conv(F.substring(F.md5(_col(value).cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % F.lit(buckets)


def tokens(text) -> Column:
    """Lower-cased whitespace tokens of the whole text (no empty tokens)."""
    return F.filter(F.split(F.lower(_col(text)), TOKEN_SEPARATORS), lambda t: t != "")


def token_indices(text, dim: int = EMBED_DIM) -> Column:
    """array<int>: the vector slot of every token of the text, in order."""
    return F.transform(tokens(text), lambda t: md5_bucket(t, dim).cast("int"))


def split_label(key, train_percent: int = 70) -> Column:
    """M4: 'train' for about ``train_percent`` % of keys, else 'test'."""
    return F.when(md5_bucket(key, 100) < F.lit(train_percent), F.lit("train")).otherwise(F.lit("test"))


def token_vectors(df, slots: str = "slots", dim: int = EMBED_DIM, name: str = "features"):
    """Sparse, L2-normalised slot-count vectors (MLlib vectors), JVM-side.

    A count vectorizer over the fixed vocabulary "0".."dim-1" maps slot k to
    index k, and the normaliser divides by the L2 norm: the same vector the
    scorer forms in its Arrow batch, but sparse (a few non-zeros per line),
    so PCA's covariance pass stays small at any scale.
    """
    from pyspark.ml.feature import CountVectorizerModel, Normalizer

    cv = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_terms",
                                              outputCol="_counts")
    out = cv.transform(df.withColumn("_terms", F.transform(slots, lambda s: s.cast("string"))))
    out = Normalizer(p=2.0, inputCol="_counts", outputCol=name).transform(out)
    return out.drop("_terms", "_counts")
