"""Prompt/target pairs and rendered chat text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.functions import text
from quillprep.params import ChatFormat, PrepParams


def prompt_target_pairs(rows: DataFrame, params: PrepParams) -> DataFrame:
    """Replace the article by the filled instruction template, the summary by the target."""
    article = text.clean_whitespace(F.col(params.article_col))
    keep = [c for c in rows.columns if c not in (params.article_col, params.summary_col)]
    return rows.select(
        *keep,
        text.fill_template(params.instruction_template, article).alias("prompt"),
        text.strip_edges(F.col(params.summary_col)).alias("target"),
    )


def with_prompt_text(pairs: DataFrame, params: PrepParams) -> DataFrame:
    """Add ``prompt_text``: system turn, user turn, opened assistant turn."""
    rendered = text.render_prompt(params.system_prompt, F.col("prompt"), params.chat)
    return pairs.withColumn("prompt_text", rendered)


def render_conversations(
    turns: DataFrame, chat: ChatFormat, open_assistant: bool = False
) -> DataFrame:
    """One rendered text per conversation from ``conv_id, turn, role, text`` rows."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(ordered.alias("messages")).select(
        "conv_id", text.render_chat(F.col("messages"), chat, open_assistant).alias("chat")
    )
