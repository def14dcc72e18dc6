"""Model and threshold store, in versions.

A model is saved into a folder of its own (``versions/<version>``: layers and
threshold), which is never written again.  Only then one line is added to the
manifest (a folder of one-line files, each committed by one rename): the line
with the highest number names the current version.  A save that dies before
that line leaves the version before it current and readable, and a reader
never pairs new layers with an old threshold.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.operators.score import Model

MANIFEST = "number long, version string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(number, version) of every version made current, the highest number now."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest").where("version IS NOT NULL")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def _last(spark: SparkSession, path: str):
    return manifest(spark, path).agg(F.max(F.struct("number", "version")).alias("m")).first()["m"]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the current version; None for a store without one (a plain
    folder of layers and threshold counts as such)."""
    last = _last(spark, path)
    return last["version"] if last else None


def make_current(spark: SparkSession, path: str, version: str) -> None:
    """Name ``version`` the current one: after its files are written, or again
    later to go back to it."""
    spark.read.parquet(f"{path}/versions/{version}/threshold").first()  # must be there
    last = _last(spark, path)
    (spark.createDataFrame([((last["number"] if last else 0) + 1, version)], MANIFEST).coalesce(1)
     .write.mode("append").json(f"{path}/manifest"))


def save_model(spark: SparkSession, model: Model, threshold: float | None, path: str) -> str:
    """Write layers, threshold and metadata as a new version and make it the
    current one; returns its name."""
    version = uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    model.to_df(spark).coalesce(1).write.parquet(f"{folder}/layers")
    meta = model.meta or {}
    spark.createDataFrame(
        [(None if threshold is None else float(threshold), str(meta.get("features", "dense")),
          int(meta.get("dim", model.input_dim)))],
        "threshold double, features string, dim int",
    ).coalesce(1).write.parquet(f"{folder}/threshold")
    make_current(spark, path, version)
    return version


def load_model(spark: SparkSession, path: str, version: str | None = None):
    """(Model, threshold) of ``version`` (default: the current one); the layer
    table is size-checked before it is brought to the driver for broadcast."""
    version = version or current_version(spark, path)
    folder = f"{path}/versions/{version}" if version else path
    model = Model.from_df(spark.read.parquet(f"{folder}/layers"))
    row = spark.read.parquet(f"{folder}/threshold").first()
    model.meta = {"features": row["features"], "dim": row["dim"]}
    return model, row["threshold"]


def write_threshold_text(spark: SparkSession, threshold: float, path: str) -> None:
    """The threshold as one line of text (Python's repr of the float)."""
    spark.createDataFrame([(repr(float(threshold)),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_threshold_text(spark: SparkSession, path: str) -> float:
    """A threshold kept as a one-line text file (or a folder holding one),
    e.g. one written by an earlier deployment."""
    row = spark.read.text(path).where("trim(value) != ''").first()
    if row is None:
        raise ValueError(f"no threshold in {path}")
    return float(row["value"].strip())
