"""Resumable runs: what is done, what is left, one record per example."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.params import ROUGE_TYPES

RECORD_KEY = ["run_id", "index"]


def remaining(todo: DataFrame, done: DataFrame) -> DataFrame:
    """Examples of ``todo`` without a record; gaps are filled as well as the rest."""
    return todo.join(done.select(*RECORD_KEY), RECORD_KEY, "left_anti")


def latest_records(records: DataFrame) -> DataFrame:
    """One record per example: that of the highest attempt; an attempt has one record.

    Only keys and attempts are aggregated, by hash and combining before the shuffle; texts are
    neither sorted nor compared.
    """
    best = records.groupBy(*RECORD_KEY).agg(F.max("attempt").alias("attempt"))
    return records.join(best, [*RECORD_KEY, "attempt"]).select(*records.columns)


def merge_records(done: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier and new records of a run as its final result."""
    return latest_records(done.unionByName(new))


def progress(records: DataFrame, target: int) -> DataFrame:
    """``completed, target`` and the mean scores so far, of one record per finished example."""
    finished = records.filter(F.col("index") < target)
    means = [F.avg(F.col("scores")[k]).alias(k) for k in ROUGE_TYPES]
    return finished.agg(F.count("*").alias("completed"), *means).select(
        "completed", F.lit(target).cast("bigint").alias("target"), *ROUGE_TYPES
    )
