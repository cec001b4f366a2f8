import math
import random

import pytest
from pyspark.sql import functions as F

from quillprep.operators.bootstrap import PER_HASH, THRESHOLDS, BootstrapParams, mean_interval, paired_difference, poisson_weight, score_interval


def records(spark, runs):
    rows = [(run, i, (x, x / 2, 0.0)) for run, scores in runs.items() for i, x in scores.items()]
    return spark.createDataFrame(rows, "run_id string, index long, scores struct<rouge1: double, rouge2: double, rougeL: double>")


def test_thresholds_are_poisson():
    steps = [b - a for a, b in zip([0, *THRESHOLDS], THRESHOLDS, strict=False)]
    assert all(abs(s / 65_536 - math.exp(-1) / math.factorial(k)) < 1 / 65_536 for k, s in enumerate(steps))


def test_weights_have_mean_and_variance_one(spark):
    digest = F.md5(F.col("id").cast("string"))
    weights = spark.range(20_000).select(*[poisson_weight(digest, k).alias(f"w{k}") for k in range(PER_HASH)])
    for k in range(PER_HASH):
        mean, var = weights.agg(F.avg(f"w{k}"), F.var_samp(f"w{k}")).head()
        assert abs(mean - 1) < 0.04 and abs(var - 1) < 0.06


def test_interval_is_as_wide_as_theory_says(spark):
    rng = random.Random(1)
    scores = {i: rng.random() for i in range(4_000)}
    got = {r.metric: r for r in score_interval(records(spark, {"r": scores}), params=BootstrapParams(replicas=800)).collect()}
    half = 1.96 * math.sqrt(1 / 12 / 4_000)
    assert got["rouge1"].n == 4_000 and got["rouge1"].mean == pytest.approx(sum(scores.values()) / 4_000)
    assert got["rouge1"].high - got["rouge1"].low == pytest.approx(2 * half, rel=0.15)
    assert got["rouge2"].low == pytest.approx(got["rouge1"].low / 2)
    assert got["rougeL"].low == got["rougeL"].high == 0.0


def test_same_on_any_partitioning(spark):
    given = records(spark, {"a": {i: (i * 37 % 100) / 100 for i in range(500)}})
    results = [sorted(map(tuple, score_interval(given.repartition(n)).select("metric", F.round("low", 9), F.round("high", 9)).collect())) for n in (1, 7)]
    assert results[0] == results[1]
    other = sorted(map(tuple, score_interval(given, params=BootstrapParams(seed=7)).select("metric", F.round("low", 9), F.round("high", 9)).collect()))
    assert other != results[0]


def test_pairing_takes_common_noise_out(spark):
    rng = random.Random(2)
    base = {i: rng.random() for i in range(1_000)}
    better = {i: x + 0.01 + rng.gauss(0, 0.01) for i, x in base.items()} | {5_000: 99.0}
    got = {r.metric: r for r in paired_difference(records(spark, {"base": base, "better": better}), "base").collect()}
    r = got["rouge1"]
    assert (r.run_id, r.n) == ("better", 1_000) and 0.008 < r.low < r.difference < r.high < 0.012 and r.above_zero == 1.0
    apart = {r.run_id: r for r in score_interval(records(spark, {"base": base, "better": better}).filter("index < 5000")).collect() if r.metric == "rouge1"}
    assert apart["base"].high > apart["better"].low  # unpaired, the two could not be told apart


def test_small_and_empty(spark):
    one = {r.metric: r for r in score_interval(records(spark, {"r": {0: 0.5}})).collect()}
    assert one["rouge1"].low == one["rouge1"].high == 0.5  # replicas without the example are left out
    none = spark.createDataFrame([], "g string, k long, x double")
    assert mean_interval(none, ["g"], "k", ("x",)).count() == 0
    for bad in ({"replicas": 12}, {"replicas": 0}, {"level": 1.0}):
        with pytest.raises(ValueError):
            BootstrapParams(**bad)
