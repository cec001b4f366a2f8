"""How far means would move with other examples: a Poisson bootstrap in one pass.

In each replica an example counts as often as a Poisson variable of mean one says, drawn from a hash of seed, key and
replica. So weights need no random state, are the same on any partitioning, and belong to the example: all runs are
resampled alike, and differences of runs are paired. Sums of weights and weighted scores combine before the shuffle, a row
for each run and eight replicas from each task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quillprep.params import ROUGE_TYPES, SEED

# Replicas that share a hash; each takes 16 bits of it.
PER_HASH = 8
_STEPS = 1 << 16


def _thresholds() -> list[int]:
    """Where the cumulative Poisson distribution of mean one passes, in steps of 2^-16."""
    out, cumulated, k = [], 0.0, 0
    while not out or out[-1] < _STEPS:
        cumulated += math.exp(-1) / math.factorial(k)
        out.append(min(_STEPS, round(cumulated * _STEPS)))
        k += 1
    return out[:-1]


THRESHOLDS = _thresholds()


@dataclass(frozen=True)
class BootstrapParams:
    """``replicas`` in eights; intervals hold ``level`` of them."""

    replicas: int = 200
    level: float = 0.95
    seed: int = SEED

    def __post_init__(self) -> None:
        if self.replicas < PER_HASH or self.replicas % PER_HASH:
            raise ValueError(f"replicas must be a positive multiple of {PER_HASH}")
        if not 0 < self.level < 1:
            raise ValueError("level must lie between 0 and 1")


def poisson_weight(digest: Column, k: int) -> Column:
    """The ``k``-th weight that a hash in hex holds."""
    drawn = F.conv(F.substring(digest, 4 * k + 1, 4), 16, 10).cast("int")
    return sum((F.when(drawn >= t, 1).otherwise(0) for t in THRESHOLDS), F.lit(0))


def _replicas(rows: DataFrame, by: list[str], key: str, metrics: tuple[str, ...], params: BootstrapParams) -> DataFrame:
    """``by, replica`` and each metric's mean in it; null where no example counts."""
    block = F.explode(F.sequence(F.lit(0), F.lit(params.replicas // PER_HASH - 1)))
    hashed = rows.select(*by, key, *metrics, block.alias("_block"))
    digest = F.md5(F.concat_ws(":", F.lit(str(params.seed)), F.col(key).cast("string"), F.col("_block").cast("string")))
    weights = {f"_w{k}": poisson_weight(F.col("_digest"), k) for k in range(PER_HASH)}
    weighed = hashed.withColumn("_digest", digest).withColumns(weights)
    sums = weighed.groupBy(*by, "_block").agg(
        *[
            F.struct(F.sum(w).alias("w"), *[F.sum(F.col(w) * F.col(m)).alias(m) for m in metrics]).alias(w)
            for w in weights
        ]
    )
    each = sums.select(*by, "_block", F.posexplode(F.array(*weights)).alias("_k", "_s"))
    means = [F.try_divide(F.col("_s")[m], F.col("_s")["w"]).alias(m) for m in metrics]
    return each.select(*by, (F.col("_block") * PER_HASH + F.col("_k")).alias("replica"), *means)


def _long(df: DataFrame, by: list[str], metrics: tuple[str, ...], value: str) -> DataFrame:
    """A row for each metric."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias(value)) for m in metrics])).alias("_m")
    kept = [c for c in df.columns if c not in metrics and c not in by]
    return df.select(*by, *kept, pairs).select(*by, *kept, "_m.*")


def mean_interval(rows: DataFrame, by: list[str], key: str, metrics: tuple[str, ...], params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """``by, metric, n, mean, low, high, above_zero`` of columns of ``rows``, one row for each ``by, key``.

    ``low`` and ``high`` bound the middle ``level`` of the replicas' means, ``above_zero`` is the share of means over 0.
    """
    tail = (1 - params.level) / 2
    replicas = _long(_replicas(rows, by, key, metrics, params), by, metrics, "value")
    spread = replicas.groupBy(*by, "metric").agg(
        F.percentile("value", F.lit(tail)).alias("low"),
        F.percentile("value", F.lit(1 - tail)).alias("high"),
        F.avg((F.col("value") > 0).cast("int")).alias("above_zero"),
    )
    means = _long(rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(m).alias(m) for m in metrics]), by, metrics, "mean")
    return means.join(spread, [*by, "metric"]).select(*by, "metric", "n", "mean", "low", "high", "above_zero")


def _scores(records: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return records.select("run_id", "index", *[F.col("scores")[k].alias(k) for k in kinds])


def score_interval(records: DataFrame, kinds: tuple[str, ...] = ROUGE_TYPES, params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """``run_id, metric, n, mean, low, high`` of final records, one for each example of a run."""
    return mean_interval(_scores(records, kinds), ["run_id"], "index", kinds, params).drop("above_zero")


def paired_difference(records: DataFrame, baseline: str, kinds: tuple[str, ...] = ROUGE_TYPES, params: BootstrapParams = BootstrapParams()) -> DataFrame:
    """``run_id, metric, n, difference, low, high, above_zero`` of every other run against the ``baseline`` run.

    Only examples that both have scored count. ``above_zero`` is the share of replicas in which the run is ahead.
    """
    scores = _scores(records, kinds)
    base = scores.filter(F.col("run_id") == baseline).select("index", *[F.col(k).alias(f"_{k}") for k in kinds])
    both = scores.filter(F.col("run_id") != baseline).join(base, "index")
    differences = both.select("run_id", "index", *[(F.col(k) - F.col(f"_{k}")).alias(k) for k in kinds])
    return mean_interval(differences, ["run_id"], "index", kinds, params).withColumnRenamed("mean", "difference")
