from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quillprep.functions.text import article_of
from quillprep.operators import runs
from quillprep.operators.pairs import prompt_target_pairs
from quillprep.operators.scoring import batch_predictor
from quillprep.params import EvalParams, PrepParams
from quillprep.plans import evaluate
from quillprep.sources.results import append_results, read_results

PARAMS = EvalParams(num_samples=20, use_stemmer=False, rows_per_commit=9)


def examples(spark, n=25):
    return spark.range(n).select(
        F.col("id").alias("index"),
        F.concat(F.lit("word"), "id", F.lit(" common")).alias("prompt"),
        F.lit("common text").alias("target"),
    )


echo = batch_predictor(lambda: lambda prompts: prompts)
shout = batch_predictor(lambda: lambda prompts: ["common text"] * len(prompts))


def never():
    raise AssertionError("nothing was left to predict")


def final(spark, path, run="r"):
    return sorted(tuple(r) for r in evaluate.run_records(spark, path, run, 20).collect())


def test_resume_after_any_loss_gives_the_same_table(spark, tmp_path):
    whole = str(tmp_path / "whole")
    mean = evaluate.evaluate_run(examples(spark), "r", whole, echo, PARAMS).head()
    want = final(spark, whole)
    assert len(want) == 20 and mean.rouge1 == pytest.approx(0.5)
    lost_sets = [lambda i: i >= 7, lambda i: i % 3 == 0, lambda i: i >= 0]
    for n, lost in enumerate(lost_sets):
        part = str(tmp_path / f"part{n}")
        append_results(read_results(spark, whole).filter(~lost(F.col("index"))), part)
        evaluate.evaluate_run(examples(spark), "r", part, echo, PARAMS)
        assert final(spark, part) == want
    again = evaluate.evaluate_run(examples(spark), "r", whole, batch_predictor(never), PARAMS)
    assert again.head() == mean
    assert final(spark, whole) == want and read_results(spark, whole).count() == 20


def test_fewer_than_stored_and_fewer_than_asked(spark, tmp_path):
    path = str(tmp_path / "r")
    evaluate.evaluate_run(examples(spark, 5), "r", path, echo, PARAMS)
    got = evaluate.check_progress(spark, path, "r", PARAMS).head()
    assert (got.completed, got.target) == (5, 20) and got.rouge1 == pytest.approx(0.5)
    small = replace(PARAMS, num_samples=3)
    assert evaluate.check_progress(spark, path, "r", small).head().completed == 3


def test_no_resume_is_a_further_attempt(spark, tmp_path):
    path = str(tmp_path / "r")
    evaluate.evaluate_run(examples(spark), "r", path, echo, PARAMS)
    mean = evaluate.evaluate_run(examples(spark), "r", path, shout, PARAMS, resume=False).head()
    assert mean.rouge1 == 1.0
    assert {r[2] for r in final(spark, path)} == {1}
    assert read_results(spark, path).count() == 40


def test_default_predictor_leads_with_the_article(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame(
        [(i, f"One two three number{i}", "one two three") for i in range(5)],
        "index long, article string, highlights string",
    )
    params = replace(PARAMS, max_new_tokens=3)
    pairs = prompt_target_pairs(rows, PrepParams())
    assert evaluate.evaluate_run(pairs, "lead", path, params=params).head().rougeL == 1.0
    records = evaluate.run_records(spark, path, "lead", 20).collect()
    assert {r.prediction for r in records} == {"one two three"}
    with pytest.raises(ValueError):
        article_of(F.col("prompt"), "{article} {article}")
    other = "TL;DR of:\n{article}\nAnswer briefly."
    pairs = prompt_target_pairs(rows, PrepParams(instruction_template=other))
    with pytest.raises(Exception, match="does not come from the given template"):
        evaluate.evaluate_run(pairs, "wrong", path, params=params)
    assert evaluate.evaluate_run(pairs, "right", path, params=params, template=other).head().rougeL == 1.0


def test_checkpoints_are_compared(spark, tmp_path):
    path = str(tmp_path / "r")
    evaluate.evaluate_checkpoint(examples(spark), "checkpoint-10", path, echo, 6, PARAMS)
    evaluate.evaluate_checkpoint(examples(spark), "checkpoint-20", path, shout, 6, PARAMS)
    got = {r.run_id: r.rouge1 for r in evaluate.compare_runs(spark, path, PARAMS.rouge_types).collect()}
    assert got == {"checkpoint-10": pytest.approx(0.5), "checkpoint-20": 1.0}


def test_results_files(spark, tmp_path):
    missing = str(tmp_path / "missing")
    assert read_results(spark, missing).count() == 0
    assert evaluate.check_progress(spark, missing, "r", PARAMS).head().completed == 0
    assert tuple(evaluate.compare_runs(spark, missing, PARAMS.rouge_types).collect()) == ()
    folder = tmp_path / "torn" / "run_id=r"
    folder.mkdir(parents=True)
    line = '{"index":%d,"attempt":0,"prediction":"p","reference":"r","scores":{"rouge1":0.5,"rouge2":0.0,"rougeL":0.5}}'
    (folder / "part.json").write_text(line % 0 + "\n\n" + line % 1 + "\n" + (line % 2)[:40])
    records = read_results(spark, str(tmp_path / "torn"))
    assert sorted(r["index"] for r in records.collect()) == [0, 1]
    todo = spark.createDataFrame([("r", i) for i in range(4)], "run_id string, index long")
    assert sorted(r["index"] for r in runs.remaining(todo, records).collect()) == [2, 3]


def test_highest_attempt_wins(spark):
    rows = [("r", 1, 0, "old"), ("r", 1, 3, "new"), ("r", 1, 1, "mid"), ("r", 2, 0, "only")]
    df = spark.createDataFrame(rows, "run_id string, index long, attempt int, prediction string")
    got = {r["index"]: r.prediction for r in runs.latest_records(df.repartition(3)).collect()}
    assert got == {1: "new", 2: "only"}
