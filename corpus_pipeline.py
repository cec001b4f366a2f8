"""From raw documents to shards: toxicity, near-duplicates, benchmark passages, mixing, sharding.

Each stage takes and, but for the last, returns the columns of ``documents``. Stages are written as
Parquet and read again, so each starts from a table and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillprep.llm import decontamination, mixing, sharding, simhash, toxicity
from quillprep.session import cut_lineage, expose_package
from quillprep.sources.tables import table

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model trained on their labels scores under its threshold."""
    expose_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    expose_package(spark)
    return simhash.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    expose_package(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard, its rack and region, and their slot in it."""
    return sharding.with_shards(docs, sharding.layout(SHARDS))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The stages learn from labels, hash with XXH64 and read fingerprints, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
