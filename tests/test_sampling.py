import hashlib

import pytest
from pyspark.sql import Window, functions as F

from quillprep.operators import sampling


def rows_of(spark, n, split="train"):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(split).alias("split"))


def expected(keys, seed, n=None):
    ordered = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    return {k: i for i, k in enumerate(ordered[:n])}


@pytest.mark.parametrize("n", [0, 1, 37, 2999, 3000, 5000])
def test_exact_size_and_order(spark, n):
    got = sampling.sample_exact(rows_of(spark, 3000), n).collect()
    assert {r.id: r["index"] for r in got} == expected([str(i) for i in range(3000)], 42, n)


def test_small_ranges_give_the_same_positions(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", 7)
    for n in (None, 100):
        got = sampling.assign_positions(rows_of(spark, 3000), {"train": n}).collect()
        assert {r.id: r["index"] for r in got} == expected([str(i) for i in range(3000)], 42, n)


def test_few_ranges_give_the_same_positions(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_RANGES", 3)
    got = sampling.assign_positions(rows_of(spark, 3000), {"train": 2500}).collect()
    assert {r.id: r["index"] for r in got} == expected([str(i) for i in range(3000)], 42, 2500)


def test_partitioning_does_not_matter(spark):
    rows = rows_of(spark, 2000)
    samples = [
        {tuple(r) for r in sampling.sample_exact(rows.repartition(p), 50, seed=7).collect()}
        for p in (1, 3, 16)
    ]
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 50


def test_per_split_sizes(spark):
    rows = rows_of(spark, 100).unionByName(rows_of(spark, 30, "test"))
    rows = rows.unionByName(rows_of(spark, 5, "extra"))
    got = sampling.sample_per_split(rows, {"train": 40, "test": 1000, "validation": 10}).collect()
    by_split = {}
    for r in got:
        by_split.setdefault(r.split, {})[r.id] = r["index"]
    assert by_split == {
        "train": expected([str(i) for i in range(100)], 42, 40),
        "test": expected([str(i) for i in range(30)], 42),
    }


def test_empty_input(spark):
    assert sampling.sample_exact(rows_of(spark, 0), 10).count() == 0


def test_no_seed_meets_a_wide_range(spark):
    total, n = 2_000_000, 500_000
    rows = spark.range(total).withColumn("split", F.lit("s"))
    hashed = rows.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(19)))).withColumn(
        "_hash", sampling.order_hash(F.col("seed").cast("string"), F.col("id"))
    )
    ranged = hashed.withColumn("_range", sampling._range_number("split", {"s": total}, {"s": n}))
    counts = ranged.groupBy("seed", "_range").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("seed").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).filter(F.col("start") < n)
    largest = reached.groupBy("seed").agg(F.max("rows").alias("rows")).collect()
    assert len(largest) == 20 and max(r.rows for r in largest) < 2 * sampling.ROWS_PER_RANGE


def test_kept_keys_are_checked_on_the_way(spark):
    twice = rows_of(spark, 200).unionByName(rows_of(spark, 200))
    with pytest.raises(Exception, match="does not identify"):
        sampling.assign_positions(twice, {"train": 50}, check_keys=True).collect()
    good = sampling.assign_positions(rows_of(spark, 200), {"train": 50}, check_keys=True).collect()
    assert {r.id: r["index"] for r in good} == expected([str(i) for i in range(200)], 42, 50)


def test_prefix(spark):
    rows = sampling.sample_exact(rows_of(spark, 20), 20)
    assert sampling.index_prefix(rows, 5).count() == 5
    assert sampling.index_prefix(rows, 50).count() == 20


def test_repeated_or_missing_keys_are_refused(spark):
    sampling.require_unique_key(rows_of(spark, 20))
    twice = rows_of(spark, 20).unionByName(rows_of(spark, 1))
    with pytest.raises(ValueError, match="does not identify"):
        sampling.require_unique_key(twice)
    missing = rows_of(spark, 2).withColumn("id", F.lit(None).cast("string"))
    with pytest.raises(ValueError):
        sampling.require_unique_key(missing.limit(1))
