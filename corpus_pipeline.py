"""A training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the docs of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.llm.common import Scratch, read_table
from logscan.llm.decontamination import decontaminate
from logscan.llm.mixing import mixed_documents
from logscan.llm.ngram_join import keep_one_per_component
from logscan.llm.sharding import shard_by_bytes
from logscan.llm.toxicity import score_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted toxic go."""
    return (score_documents(docs, read_table(spark, sf_dir, "labels")).where("predicted = 0")
            .select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies stays."""
    return keep_one_per_component(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents with benchmark windows go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the mix by source weights, one row per document and pass
    that takes words of it."""
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: 16 shards of near equal bytes."""
    return shard_by_bytes(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# The classifier and the mix have no SQL form; the pipeline is tested against
# a brute-force version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
