"""What a token budget would cut, for all budgets at once, from mergeable sketches of lengths.

One pass keeps a KLL sketch of prompt, target and whole lengths for each group. Sketches of parts, as of
daily loads, merge into those of the whole, and any of them answers for any budget without reading texts again.
A share is off by at most about ``2.3 / k ** 0.97`` of all examples, with a probability of 99 %, and exact while a group
has fewer examples than ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

K = 4_096
LENGTHS = ("prompt", "target", "whole")


def rank_error(k: int = K) -> float:
    """How far a share may be off."""
    return 2.296 / k**0.9723


def length_sketches(tokenized: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """``by, n, prompt, target, whole``: sketches of token counts, the target's end token included."""
    prompt, target = F.size("prompt_tokens"), F.size("target_tokens") + 1
    sizes = dict(zip(LENGTHS, (prompt, target, prompt + target), strict=True))
    sketches = [F.kll_sketch_agg_bigint(f"_{c}", F.lit(k)).alias(c) for c in LENGTHS]
    sized = tokenized.select(*by, *[s.cast("long").alias(f"_{c}") for c, s in sizes.items()])
    return sized.groupBy(*by).agg(F.count("*").alias("n"), *sketches)


def merge_sketches(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Sketches of finer groups or other loads as those of ``by``."""
    merged = [F.kll_merge_agg_bigint(c, F.lit(k)).alias(c) for c in LENGTHS]
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), *merged)


def budget_curve(sketches: DataFrame, by: list[str], budgets: list[int]) -> DataFrame:
    """``by, budget`` and the shares of examples whose prompt, target or whole is longer than the budget."""
    asked = F.array(*[F.lit(b).cast("long") for b in budgets])
    within = [F.kll_sketch_get_rank_bigint(c, asked).alias(c) for c in LENGTHS]
    each = sketches.select(*by, "n", F.explode(F.arrays_zip(asked.alias("budget"), *within)).alias("e"))
    return each.select(*by, "e.budget", "n", *[(1 - F.col(f"e.{c}")).alias(f"{c}_cut") for c in LENGTHS])


def budget_for(sketches: DataFrame, by: list[str], kept: float) -> DataFrame:
    """``by`` and the least budgets that keep a share of the examples' prompts, targets and wholes uncut."""
    least = [F.kll_sketch_get_quantile_bigint(c, F.lit(kept)).alias(c) for c in LENGTHS]
    return sketches.select(*by, "n", *least)
