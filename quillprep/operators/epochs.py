"""Epoch plans: seeded order, micro-batch and optimizer step of each training example."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillprep.operators.sampling import assign_positions
from quillprep.operators.windows import with_ranks
from quillprep.params import PrepParams
from quillprep.session import cut_lineage


def epoch_plan(
    examples: DataFrame, params: PrepParams, epochs: int = 1, key: str = "id"
) -> DataFrame:
    """Add ``epoch, position, micro_batch, step``; each epoch has its own order.

    Pass narrow rows: they are repeated once per epoch and shuffled by their hash range.
    """
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    repeated = examples.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    seed = F.concat_ws("/", F.lit(params.seed), F.col("epoch"))
    sizes = {epoch: None for epoch in range(epochs)}
    placed = assign_positions(repeated, sizes, "epoch", key, seed, "position")
    per_step = params.batch_size * params.accumulation
    return placed.withColumns(
        {
            "micro_batch": F.floor(F.col("position") / params.batch_size),
            "step": F.floor(F.col("position") / per_step),
        }
    )


def epoch_plan_bucketed(
    examples: DataFrame, params: PrepParams, epochs: int = 1, key: str = "id", length: str = "length", strata: int = 8
) -> DataFrame:
    """The same with steps of examples of like length, in an order that has nothing to do with length.

    Lengths are cut into ``strata`` of about equal size by quantiles. In each, examples are shuffled and fill steps;
    full steps of all strata are shuffled; what fills no step, less than one of each stratum, is shuffled together and
    comes last. All orders follow from the seed, the epoch and the key.
    """
    if epochs < 1 or strata < 1:
        raise ValueError("epochs and strata must be at least 1")
    per_step = params.batch_size * params.accumulation
    shares = F.array(*[F.lit(k / strata) for k in range(1, strata)]) if strata > 1 else None
    cuts = examples.agg(F.percentile_approx(length, shares)).head()[0] or [] if strata > 1 else []
    stratum = sum((F.when(F.col(length) > c, 1).otherwise(0) for c in cuts), F.lit(0))
    sized = cut_lineage(examples.withColumn("_stratum", stratum))
    counts = sized.groupBy("_stratum").agg(F.count("*").alias("_n"))  # a row for each stratum
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).head()[0]
    parts = [_bucketed(sized, counts, total, epoch, f"{params.seed}/{epoch}", per_step, key) for epoch in range(epochs)]
    planned = parts[0]
    for part in parts[1:]:
        planned = planned.unionByName(part)
    return planned.select(
        *examples.columns,
        "epoch",
        "position",
        F.floor(F.col("position") / params.batch_size).alias("micro_batch"),
        F.floor(F.col("position") / per_step).alias("step"),
    )


def _bucketed(sized: DataFrame, counts: DataFrame, total: int, epoch: int, seed: str, per_step: int, key: str) -> DataFrame:
    ranked = with_ranks(sized, "_stratum", key, seed, total)
    whole = counts.withColumn("_full", F.expr(f"_n div {per_step}"))
    named = F.concat_ws("-", "_stratum", "_nth")
    steps = whole.filter("_full > 0").select("_stratum", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)).alias("_nth"))
    steps = steps.select("_stratum", "_nth", named.alias("_name"), F.lit(0).alias("_all"))
    full = whole.agg(F.coalesce(F.sum("_full"), F.lit(0))).head()[0]
    ordered = with_ranks(steps, "_all", "_name", f"{seed}/steps", full).select("_stratum", "_nth", F.col("rank").alias("_step"))
    placed = ranked.withColumn("_nth", F.expr(f"rank div {per_step}")).join(ordered, ["_stratum", "_nth"], "left")
    # less than a step of each stratum
    rest = Window.partitionBy(F.col("_step").isNull()).orderBy(F.md5(F.concat_ws(":", F.lit(f"{seed}/rest"), F.col(key).cast("string"))), key)
    inside = placed.filter(F.col("_step").isNotNull()).withColumn("position", F.expr(f"_step * {per_step} + rank % {per_step}"))
    last = placed.filter(F.col("_step").isNull()).withColumn("position", F.row_number().over(rest) - 1 + F.lit(full * per_step))
    return inside.unionByName(last).withColumn("epoch", F.lit(epoch))


def step_token_stats(planned: DataFrame, params: PrepParams) -> DataFrame:
    """Signal per optimizer step, from ``prompt_len`` and ``target_len`` after the cut."""
    used = F.sum(F.col("prompt_len") + F.col("target_len"))
    slots = F.count("*") * params.max_len
    return planned.groupBy("epoch", "step").agg(
        F.count("*").alias("examples"),
        F.sum("target_len").alias("target_tokens"),
        F.sum("prompt_len").alias("prompt_tokens"),
        F.round((slots - used) / slots, 6).alias("padding_share"),
    )
