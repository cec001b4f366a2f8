"""Rows in a global order without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillprep.session import cut_lineage


def in_pieces(rows: DataFrame, order: list[Column], pieces: int, name: str) -> DataFrame:
    """The rows dealt into at most ``pieces`` ranges of ``order`` and sorted in each; ``name`` has the range's number.

    ``row_no`` must be a column that no two rows share: it settles ties, so that a key of any weight is cut like the others.
    Ranges come from Spark's sample of the keys, for which ``rows`` are read once more.
    """
    by = [*order, F.col("row_no")]
    return rows.repartitionByRange(max(1, pieces), *by).sortWithinPartitions(*by).withColumn(name, F.spark_partition_id())


def numbered(rows: DataFrame) -> DataFrame:
    """The rows written once, with a ``row_no`` of their own."""
    return cut_lineage(rows.withColumn("row_no", F.monotonically_increasing_id()))
