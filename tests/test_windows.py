import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillprep.operators.packing import pack
from quillprep.operators.windows import assign_windows, packed_windows, plan_windows, with_ranks
from quillprep.params import PrepParams


def first_fit(lengths, budget):
    """Window of each length, longest first, one at a time."""
    rooms, out = [], []
    for n in sorted(lengths, reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= n), len(rooms))
        if at == len(rooms):
            rooms.append(budget)
        rooms[at] -= n
        out.append((n, at))
    return out, len(rooms)


def planned(counts, plan):
    out = []
    for n in sorted(counts, reverse=True):
        own = [s for s in plan if s.length == n]
        assert [s.start for s in own] == sorted({s.start for s in own})
        for rank in range(counts[n]):
            s = [s for s in own if s.start <= rank][-1]
            out.append((n, s.first + (rank - s.start) // s.each))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_first_fit_decreasing(seed):
    rng = random.Random(seed)
    budget = rng.choice([1, 7, 30, 64])
    lengths = [rng.randint(1, budget) if rng.random() < 0.7 else budget for _ in range(rng.randrange(200))]
    plan, windows = plan_windows(Counter(lengths), budget)
    assert (planned(Counter(lengths), plan), windows) == first_fit(lengths, budget)


def test_plan_of_many_examples_is_short():
    plan, windows = plan_windows({n: 10**9 + n for n in range(1, 513)}, 512)
    total = sum(n * (10**9 + n) for n in range(1, 513))
    assert len(plan) < 5_000 and total / 512 <= windows < 1.02 * total / 512
    with pytest.raises(ValueError):
        plan_windows({513: 1}, 512)


def test_ranks_of_a_crowded_group(spark):
    rows = spark.range(5_000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("g"))
    got = defaultdict(list)
    for r in with_ranks(rows, "g", "id", 1, 5_000).collect():
        got[r.g].append(r["rank"])
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in got.values())


def test_windows_hold_each_example_once(spark):
    rng = random.Random(1)
    params = PrepParams(max_len=40, max_target=20, eos_id=9, pad_id=0)
    rows = [(f"e{i}", [i] * rng.randint(0, 20), [i] * rng.randint(0, 19) + [9]) for i in range(300)]
    examples = spark.createDataFrame(rows, "id string, prompt_ids array<int>, target_ids array<int>").repartition(4)
    got = packed_windows(examples, params).collect()
    given = {r[0]: r for r in rows}
    assert sorted(k for w in got for k in w["keys"]) == sorted(given)
    assert sorted(w.window for w in got) == list(range(len(got)))
    padding = 0
    for w in got:
        at = 0
        assert len(w.input_ids) == len(w.labels) == len(w.segment_ids) == len(w.positions) == 40
        for n, k in enumerate(w["keys"]):
            _, prompt, target = given[k]
            size = len(prompt) + len(target)
            span = slice(at, at + size)
            assert w.input_ids[span] == prompt + target and w.labels[span] == [-100] * len(prompt) + target
            assert w.segment_ids[span] == [n + 1] * size and w.positions[span] == list(range(size))
            at += size
        assert set(w.input_ids[at:]) | set(w.segment_ids[at:]) <= {0} and set(w.labels[at:]) <= {-100}
        padding += 40 - at
    alone = pack(examples, params).agg(F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + 1 - x))).head()[0]
    assert padding / (40 * len(got)) < 0.1 < alone / (40 * 300)
    again = packed_windows(examples.repartition(2), params).collect()
    assert {w.window: w["keys"] for w in again} == {w.window: w["keys"] for w in got}


def test_long_windows_are_planned_in_steps(spark):
    rows = [(f"e{i}", 1 + 37 * i % 9_000) for i in range(400)]
    got = defaultdict(int)
    for r in assign_windows(spark.createDataFrame(rows, "id string, length int"), 10_000).collect():
        got[r.window] += r.length
    assert max(got.values()) <= 10_000 and sum(got.values()) == sum(n for _, n in rows)


def test_no_examples(spark):
    examples = spark.createDataFrame([], "id string, prompt_ids array<int>, target_ids array<int>")
    assert packed_windows(examples, PrepParams()).count() == 0
