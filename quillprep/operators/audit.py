"""Training-signal audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.functions import arrays
from quillprep.params import PrepParams


def fully_masked_count(packed: DataFrame, by: list[str]) -> DataFrame:
    """Examples per group whose labels are all ignored."""
    return packed.groupBy(*by).agg(
        F.count("*").alias("examples"),
        F.count_if(arrays.fully_masked(F.col("labels"))).alias("fully_masked"),
    )


def truncation_audit(tokenized: DataFrame, params: PrepParams, by: list[str]) -> DataFrame:
    """What two truncation rules cost per group, from whole token counts.

    Naive: prompt and target joined, then cut at ``max_len``; a prompt of ``max_len`` tokens or
    more leaves no label. Reserved: the prompt is cut to ``max_len - max_target`` first.
    """
    prompt = F.size("prompt_tokens")
    target = F.size("target_tokens") + 1  # with the end token
    sizes = tokenized.select(*by, prompt.alias("prompt_len"), target.alias("target_len"))
    budget = params.max_len - params.max_target
    reserved_prompt = F.least(F.col("prompt_len"), F.lit(budget))
    naive_lost = F.col("prompt_len") >= params.max_len
    reserved_lost = reserved_prompt >= params.max_len
    target_cut = F.col("target_len") > params.max_len - reserved_prompt
    share = lambda condition: F.round(F.count_if(condition) / F.count("*"), 6)
    return sizes.groupBy(*by).agg(
        F.count("*").alias("examples"),
        F.count_if(naive_lost).alias("naive_lost"),
        share(naive_lost).alias("naive_lost_share"),
        F.count_if(reserved_lost).alias("reserved_lost"),
        share(reserved_lost).alias("reserved_lost_share"),
        F.count_if(F.col("prompt_len") > budget).alias("prompt_cut"),
        F.count_if(target_cut).alias("target_cut"),
        F.round(F.percentile("prompt_len", F.lit(0.5)), 6).alias("prompt_len_p50"),
        F.round(F.percentile("prompt_len", F.lit(0.9)), 6).alias("prompt_len_p90"),
        F.round(F.percentile("target_len", F.lit(0.5)), 6).alias("target_len_p50"),
        F.max("prompt_len").alias("prompt_len_max"),
    )
