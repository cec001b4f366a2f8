import os
import random

import pytest
from pyspark.sql import functions as F

from quillprep.sources.results import append_results, read_results
from quillprep.sources.store import commit_slice, finished, finished_of, manifests, read_slices, remaining_by_bitmap


def records(spark, indices, prediction="p", partitions=3):
    rows = [("r", i, 0, prediction, "ref", (1.0, 0.5, 0.25)) for i in indices]
    schema = "run_id string, index long, attempt int, prediction string, reference string, scores struct<rouge1: double, rouge2: double, rougeL: double>"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def indices(df):
    return sorted(r["index"] for r in df.select("index").collect())


def test_slice_counts_once(spark, tmp_path):
    path = str(tmp_path / "store")
    assert read_slices(spark, path).count() == 0
    commit_slice(records(spark, range(10)), path, "r", "a")
    commit_slice(records(spark, range(10, 15)), path, "r", "b")
    commit_slice(records(spark, range(10), "again"), path, "r", "a")
    got = read_slices(spark, path)
    assert indices(got) == list(range(15))
    assert {(r["index"], r.prediction) for r in got.collect()} == {(i, "again" if i < 10 else "p") for i in range(15)}
    assert sorted((r.slice, r.records) for r in manifests(spark, path).collect()) == [("a", 10), ("b", 5)]
    assert got.columns == ["run_id", "index", "attempt", "prediction", "reference", "scores"]


def test_attempts_and_runs_are_apart(spark, tmp_path):
    path, odd = str(tmp_path / "store"), "run/1 é=?"
    commit_slice(records(spark, [1]), path, "r", "a")
    commit_slice(records(spark, [1]), path, "r", "a", attempt=1)
    commit_slice(records(spark, [1]), path, odd, "a/../b")
    got = sorted((r.run_id, r.attempt) for r in read_slices(spark, path).collect())
    assert got == [("r", 0), ("r", 1), (odd, 0)]


def test_failed_write_leaves_nothing_visible(spark, tmp_path):
    path = str(tmp_path / "store")
    commit_slice(records(spark, range(5)), path, "r", "a")
    broken = records(spark, range(20), "broken", 4)
    late = F.when(F.col("index") == 17, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("prediction"))
    with pytest.raises(Exception, match="lost"):
        commit_slice(broken.withColumn("prediction", late), path, "r", "a")
    assert {r.prediction for r in read_slices(spark, path).collect()} == {"p"}
    # files that no manifest names, as a killed job leaves them, are not read
    stray = tmp_path / "store" / "_slices" / "s-r" / "s-0" / "s-a" / "killed"
    records(spark, [99]).write.parquet(str(stray))
    assert indices(read_results(spark, path)) == list(range(5))
    assert indices(remaining_by_bitmap(records(spark, range(8)), finished(spark, path))) == [5, 6, 7]


def test_unfinished_manifest_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "store")
    commit_slice(records(spark, range(5)), path, "r", "a")
    folder = tmp_path / "store" / "_commits" / "s-r" / "s-0"
    (folder / "_half").write_text('{"run_id": "r", "fil')
    assert manifests(spark, path).count() == 1 and len(os.listdir(folder)) >= 2


def test_bad_index(spark, tmp_path):
    for bad in (None, -1):
        with pytest.raises(Exception, match="index of 0 or more"):
            commit_slice(records(spark, [1, bad]), str(tmp_path / "s"), "r", "a")
    assert read_slices(spark, str(tmp_path / "s")).count() == 0


def test_bitmaps_equal_the_anti_join(spark, tmp_path):
    path, rng = str(tmp_path / "store"), random.Random(1)
    near = [0, 1, 7, 8, 32_766, 32_767, 32_768, 65_535, 65_536, 3_000_000_000]
    done = sorted({*near[::2], *rng.sample(range(100_000), 3_000)})
    commit_slice(records(spark, done[:1_500]), path, "r", "a")
    commit_slice(records(spark, done[1_000:]), path, "r", "b")
    every = sorted({*near, *rng.sample(range(100_000), 5_000), *done})
    todo = records(spark, every).select("run_id", "index").unionByName(spark.createDataFrame([("other", 0)], "run_id string, index long"))
    want = sorted([("r", i) for i in set(every) - set(done)] + [("other", 0)])
    for bitmaps in (finished(spark, path), finished_of(read_slices(spark, path))):
        assert sorted(map(tuple, remaining_by_bitmap(todo, bitmaps).collect())) == want
    plan = finished(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "prediction" not in plan and "_slices" not in plan


def test_json_lines_beside_slices(spark, tmp_path):
    path = str(tmp_path / "store")
    append_results(records(spark, [1, 2]), path)
    commit_slice(records(spark, [3]), path, "r", "a")
    assert indices(read_results(spark, path)) == [1, 2, 3]


def test_empty_slice(spark, tmp_path):
    path = str(tmp_path / "store")
    commit_slice(records(spark, [1]).filter("false"), path, "r", "a")
    assert read_slices(spark, path).count() == 0 and manifests(spark, path).head().records == 0
