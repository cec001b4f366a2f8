"""Budgets, small samples, bucketed epochs and predictions by budget."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillprep.operators.budgets import LENGTHS, budget_curve, budget_for, length_sketches, merge_sketches, rank_error
from quillprep.operators.epochs import epoch_plan, epoch_plan_bucketed
from quillprep.operators.sampling import SMALL, sample_per_split, sample_small
from quillprep.operators.scoring import budget_batches, predict_by_budget
from quillprep.params import PrepParams


def tokenized(spark, rows):
    words = lambda n: F.array_repeat(F.lit("w"), F.col(n))
    df = spark.createDataFrame(rows, "split string, part int, p int, t int")
    return df.select("split", "part", words("p").alias("prompt_tokens"), words("t").alias("target_tokens"))


def test_merged_sketches_stay_within_their_error(spark):
    rng = random.Random(1)
    rows = [("train", i % 5, int(rng.expovariate(1 / 60)), rng.randrange(30)) for i in range(6_000)]
    budgets, k = [5, 20, 60, 100, 200, 10_000], 200
    merged = merge_sketches(length_sketches(tokenized(spark, rows), ["split", "part"], k), ["split"], k)
    for r in budget_curve(merged, ["split"], budgets).collect():
        assert r.n == 6_000
        for name, size in zip(LENGTHS, (lambda p, t: p, lambda p, t: t + 1, lambda p, t: p + t + 1), strict=True):
            want = sum(size(p, t) > r.budget for _, _, p, t in rows) / len(rows)
            assert abs(r[f"{name}_cut"] - want) <= 2 * rank_error(k)
    least = budget_for(merged, ["split"], 0.9).head().prompt
    assert abs(sum(p <= least for _, _, p, _ in rows) / len(rows) - 0.9) <= 2 * rank_error(k)


def test_small_groups_are_exact(spark):
    rows = [("a", 0, n, 0) for n in range(10)] + [("b", 0, 7, 2)]
    got = {(r.split, r.budget): r.prompt_cut for r in budget_curve(length_sketches(tokenized(spark, rows), ["split"]), ["split"], [4, 7]).collect()}
    assert got == {("a", 4): pytest.approx(0.5), ("a", 7): pytest.approx(0.2), ("b", 4): 1.0, ("b", 7): 0.0}


def test_small_sample_equals_the_ranges(spark):
    rows = spark.range(3_000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("split"), F.lit(1).alias("other"))
    sizes = {"x": 40, "y": 7, "none": 5}
    small, want = sample_small(rows.repartition(9), sizes, seed=3), sample_per_split(rows, sizes, "id", 3)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, want.collect()))
    assert small.columns == want.columns
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") + plan.count("Range (") == 1 or plan.count("Range (0") <= 2
    assert "WindowGroupLimit" in plan
    assert sample_small(rows, {"x": 5_000}, seed=3).count() == 1_000
    with pytest.raises(ValueError, match="sample_per_split"):
        sample_small(rows, {"x": SMALL + 1})


def lengths(spark, n=1_000):
    return spark.range(n).select(F.concat(F.lit("e"), "id").alias("id"), (F.col("id") * 7919 % 503 + 1).cast("int").alias("length"))


def test_bucketed_epochs(spark):
    params = PrepParams(batch_size=4, accumulation=2)
    rows = lengths(spark)
    plan = epoch_plan_bucketed(rows, params, 2, strata=5).collect()
    assert plan[0].__fields__ == ["id", "length", "epoch", "position", "micro_batch", "step"]
    orders = []
    for epoch in range(2):
        own = sorted((r for r in plan if r.epoch == epoch), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1_000)) and len({r.id for r in own}) == 1_000
        assert all(r.step == r.position // 8 and r.micro_batch == r.position // 4 for r in own)
        orders.append([r.id for r in own])
        means = [sum(r.length for r in own[at : at + 8]) / 8 for at in range(0, 960, 8)]
        assert means != sorted(means) and means != sorted(means, reverse=True)
    assert orders[0] != orders[1]
    again = sorted(epoch_plan_bucketed(rows.repartition(7), params, 2, strata=5).collect(), key=lambda r: (r.epoch, r.position))
    assert [r.id for r in again] == orders[0] + orders[1]

    def padding(rows):
        steps = defaultdict(list)
        for r in rows:
            steps[r.epoch, r.step].append(r.length)
        return sum(max(s) * len(s) - sum(s) for s in steps.values())

    assert padding(plan) < 0.5 * padding(epoch_plan(rows, params, 2).collect())


def test_bucketed_edges(spark):
    params = PrepParams(batch_size=4, accumulation=2)
    assert epoch_plan_bucketed(lengths(spark, 0), params).count() == 0
    few = epoch_plan_bucketed(lengths(spark, 5), params, strata=1).collect()
    assert sorted(r.position for r in few) == list(range(5))
    same = lengths(spark, 100).withColumn("length", F.lit(9))
    assert sorted(r.position for r in epoch_plan_bucketed(same, params).collect()) == list(range(100))


def test_batches_keep_the_budget():
    rng = random.Random(2)
    for _ in range(200):
        sizes, budget = [rng.randrange(50) for _ in range(rng.randrange(60))], rng.randrange(1, 200)
        batches = list(budget_batches(sizes, budget))
        assert sorted(k for b in batches for k in b) == list(range(len(sizes)))
        assert all(max(sizes[k] for k in b) * len(b) <= budget or len(b) == 1 for b in batches)


def test_predictions_keep_their_rows(spark):
    rows = [(i, None if i % 11 == 0 else "word " * (i * 37 % 50), f"x{i}") for i in range(300)]
    prompts = spark.createDataFrame(rows, "n long, prompt string, other string").repartition(3)

    def model():
        def answer(texts):
            assert len(texts) == 1 or max(map(len, texts)) * len(texts) <= 900
            return [f" {len(t)} " for t in texts]

        return answer

    got = predict_by_budget(prompts, model, 900, pool=64).collect()
    assert {(r.n, r.prediction, r.other) for r in got} == {(n, None if p is None else str(len(p)), o) for n, p, o in rows}
    with pytest.raises(Exception, match="0 texts for"):
        predict_by_budget(prompts, lambda: lambda texts: [], 900).collect()
    assert predict_by_budget(prompts.filter("false"), model, 900).count() == 0
