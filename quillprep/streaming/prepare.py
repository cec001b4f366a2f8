"""Incremental preparation: row-wise and stateless, from arriving files to a file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillprep.operators.pairs import prompt_target_pairs, with_prompt_text
from quillprep.params import PrepParams


def prepare_stream(rows: DataFrame, params: PrepParams) -> DataFrame:
    """Streaming rows to prompt, target and rendered prompt."""
    return with_prompt_text(prompt_target_pairs(rows, params), params)


def start_prepare(
    rows: DataFrame, path: str, checkpoint: str, params: PrepParams
) -> StreamingQuery:
    """Prepare what has arrived since the last run, append it as Parquet, then stop."""
    return (
        prepare_stream(rows, params)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
