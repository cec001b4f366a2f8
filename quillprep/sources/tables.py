"""Adapters from the given tables to ``id, split, lang, article, highlights``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# the whole text where no sentence ends
FIRST_SENTENCE = r"^[^.!?]*(?:[.!?]|\z)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(number: Column) -> Column:
    """Eight of ten to train, one to validation, one to test."""
    digit = number % 10
    return F.when(digit < 8, "train").when(digit == 8, "validation").otherwise("test")


def documents(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The documents as their files split, or dealt out to ``partitions`` tasks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs if partitions is None else docs.repartition(partitions)


def idle_cores(spark: SparkSession, sf_dir: str) -> int | None:
    """``partitions`` for ``documents``: all cores where the files split into fewer tasks, else none.

    A file of one row group is read by one task. Beyond a split for each core nothing is dealt out.
    """
    cores = spark.sparkContext.defaultParallelism
    splits = table(spark, sf_dir, "documents").select("doc_id").rdd.getNumPartitions()
    return cores if splits < cores else None


def pairs_of_documents(docs: DataFrame) -> DataFrame:
    """Each document with its first sentence as the summary; batch or stream."""
    return docs.select(
        F.concat(F.lit("d"), "doc_id").alias("id"),
        split_of(F.col("doc_id")).alias("split"),
        "lang",
        F.col("text").alias("article"),
        F.regexp_extract("text", FIRST_SENTENCE, 0).alias("highlights"),
    )


def document_pairs(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    return pairs_of_documents(documents(spark, sf_dir, partitions))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each assistant turn whose turn before it is the user's; turn numbers may have gaps.

    Neighbours are found by rank inside a conversation, whose turns are sorted in one task.
    """
    order = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumns(
        {"_role": F.lag("role").over(order), "article": F.lag("text").over(order)}
    )
    answered = turns.filter((F.col("role") == "assistant") & (F.col("_role") == "user"))
    return answered.withColumnRenamed("text", "highlights").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"),
        split_of(F.col("conv_id")).alias("split"),
        F.lit("any").alias("lang"),
        "article",
        "highlights",
    )


def all_pairs(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Both adapters in one DataFrame."""
    return document_pairs(spark, sf_dir, partitions).unionByName(conversation_pairs(spark, sf_dir))
