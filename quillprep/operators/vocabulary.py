"""Vocabulary tables: token to id, most frequent first."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillprep.session import cut_lineage

# Reserved tokens in id order.
RESERVED = ("<|pad|>", "<|unk|>", "<|eos|>")
PAD_ID, UNK_ID, EOS_ID = range(3)

# A vocabulary up to both bounds is broadcast; a larger one is joined.
BROADCAST_TOKENS = 1_000_000
BROADCAST_BYTES = 64 << 20


def token_counts(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Occurrences per token of an array column.

    ``explode_outer``: the filter Catalyst derives from ``explode`` would run the token pattern
    a second and third time.
    """
    exploded = tokens.select(F.explode_outer(column).alias("token"))
    return (
        exploded.groupBy("token")
        .agg(F.count("*").alias("count"))
        .filter(F.col("token").isNotNull() & ~F.col("token").isin(*RESERVED))
    )


def top_tokens(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent tokens, ties by token, as ``token, token_id`` with reserved rows.

    Counts are first cut by their power of two, so the final sort gets few more than ``size``
    rows instead of ``size`` rows from every partition.
    """
    spark = counts.sparkSession
    counts = cut_lineage(counts)
    leveled = counts.withColumn("_level", F.floor(F.log2("count")))
    levels = leveled.groupBy("_level").agg(F.count("*").alias("_n"))  # at most 64 rows
    above = Window.orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, -1)
    lowest = (
        levels.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        .filter(F.col("_above") < size)
        .agg(F.min("_level").alias("_lowest"))
    )
    order = [F.desc("count"), F.asc("token")]
    top = (
        leveled.filter(F.col("_level") >= lowest.scalar())
        .orderBy(*order)
        .limit(size)
        .select("token", (F.row_number().over(Window.orderBy(*order)) + 2).alias("token_id"))
    )
    rows = ", ".join(f"('{token}', {number})" for number, token in enumerate(RESERVED))
    reserved = spark.sql(f"SELECT * FROM VALUES {rows} AS reserved(token, token_id)")
    return reserved.unionByName(top)


def build_vocabulary(tokens: DataFrame, size: int, column: str = "tokens") -> DataFrame:
    """Vocabulary of an array column, as a checkpointed table of ``size`` + 3 rows at most."""
    return cut_lineage(top_tokens(token_counts(tokens, column), size))


@dataclass(frozen=True)
class Lookup:
    """A vocabulary small enough to broadcast: an Arrow array of its tokens in id order."""

    tokens: Broadcast
    size: int


def broadcast_lookup(spark: SparkSession, vocabulary: DataFrame) -> Lookup | None:
    """Broadcast a vocabulary whose size has been measured; ``None`` if it is too large."""
    n, size, lowest, highest = vocabulary.agg(
        F.count("*"), F.sum(F.octet_length("token")), F.min("token_id"), F.max("token_id")
    ).head()
    if n > BROADCAST_TOKENS or (size or 0) > BROADCAST_BYTES:
        return None
    if n and (lowest, highest) != (0, n - 1):
        raise ValueError("vocabulary ids must run from 0 without a gap")
    rows = vocabulary.select("token_id", "token").collect()
    tokens = [token for _, token in sorted(rows)]
    return Lookup(spark.sparkContext.broadcast(pa.array(tokens, pa.string())), n)
