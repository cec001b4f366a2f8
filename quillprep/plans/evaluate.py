"""Evaluation runs: predict, score, append, average; resumable per slice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillprep.functions.text import article_of, fill_template
from quillprep.operators.runs import latest_records, progress
from quillprep.operators.sampling import index_prefix
from quillprep.operators.scoring import lead_prediction, mean_scores, score_records
from quillprep.params import INSTRUCTION_TEMPLATE, SPOT_CHECK_SAMPLES, EvalParams
from quillprep.session import scratch_path
from quillprep.sources.results import read_lines, read_results
from quillprep.sources.store import commit_slice, finished, finished_of, remaining_by_bitmap

Predictor = Callable[[Column], Column]


def run_records(spark: SparkSession, path: str, run_id: str, n: int) -> DataFrame:
    """A run's final records among its first ``n`` examples."""
    mine = read_results(spark, path).filter(F.col("run_id") == run_id)
    return latest_records(index_prefix(mine, n))


def lead_baseline(params: EvalParams, template: str = INSTRUCTION_TEMPLATE) -> Predictor:
    """The default predictor: the article's first ``max_new_tokens`` scoring tokens.

    The job fails on a prompt that was not made from ``template``.
    """

    def predict(prompt: Column) -> Column:
        article = article_of(prompt, template)
        fits = article.isNotNull() & (fill_template(template, article) == prompt)
        fault = F.raise_error(F.lit("a prompt does not come from the given template; pass its own"))
        article = F.when(fits, article).otherwise(fault.cast("string"))
        return lead_prediction(article, params.max_new_tokens, params.pattern)

    return predict


def _scores_only(records: DataFrame) -> DataFrame:
    """Leave the texts in the files before records are compared by attempt."""
    return records.select("run_id", "index", "attempt", "scores")


def run_scores(spark: SparkSession, path: str, run_id: str, n: int) -> DataFrame:
    """A run's final scores among its first ``n`` examples, without texts."""
    mine = read_results(spark, path).filter(F.col("run_id") == run_id)
    return latest_records(_scores_only(index_prefix(mine, n)))


def run_finished(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """What a run has finished, as bitmaps: of its slices by their manifests, of its JSON lines by their keys."""
    bitmaps = finished(spark, path).unionByName(finished_of(read_lines(spark, path).select("run_id", "index")))
    mine = bitmaps.filter(F.col("run_id") == run_id)
    return mine.groupBy("run_id", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def check_progress(spark: SparkSession, path: str, run_id: str, params: EvalParams) -> DataFrame:
    """``completed, target`` and mean scores so far of a run; safe while it is running."""
    records = run_scores(spark, path, run_id, params.num_samples)
    return progress(records, params.num_samples)


def evaluate_run(
    examples: DataFrame,
    run_id: str,
    path: str,
    predictor: Predictor | None = None,
    params: EvalParams = EvalParams(),
    resume: bool = True,
    template: str = INSTRUCTION_TEMPLATE,
) -> DataFrame:
    """Score the first ``num_samples`` of ``index, prompt, target`` and return the mean scores.

    ``predictor`` gets the column ``prompt``; render chat turns into it first where the model wants
    them (``with_prompt_text``). Without one, the article's lead is taken, by ``template``.

    What is left to do, by the bitmaps of what is finished, is written once, a folder for each
    ``rows_per_commit`` positions along ``index``. Then one such slice after another is read, scored and committed,
    and a killed run goes on after its last commit. A slice is known by the positions it finishes, so one that
    comes twice counts once. ``resume=False`` scores everything again as a further attempt.
    """
    spark = examples.sparkSession
    n, width = params.num_samples, params.rows_per_commit
    predictor = predictor or lead_baseline(params, template)
    todo = index_prefix(examples, n).select(F.lit(run_id).alias("run_id"), "index", "prompt", "target")
    attempt = 0
    if resume:
        todo = remaining_by_bitmap(todo, run_finished(spark, path, run_id))
    else:
        earlier = run_scores(spark, path, run_id, n).agg(F.max("attempt")).head()[0]
        attempt = 0 if earlier is None else earlier + 1
    sliced = scratch_path(spark, "todo")
    todo.withColumn("_slice", F.expr(f"index div {width}")).write.partitionBy("_slice").parquet(sliced)
    kept = spark.read.schema(todo.schema.add("_slice", "long")).parquet(sliced)
    # a row for each commit that follows
    slices = kept.groupBy("_slice").agg(F.sum(F.xxhash64("index").cast("decimal(38,0)")).alias("digest"))
    for number, digest in sorted((r["_slice"], r.digest) for r in slices.collect()):
        part = kept.filter(F.col("_slice") == number).drop("_slice")
        predicted = part.select(
            "run_id",
            "index",
            predictor(F.col("prompt")).alias("prediction"),
            F.col("target").alias("reference"),
        )
        name = f"{number * width}-{(number + 1) * width - 1}-{digest}"
        commit_slice(score_records(predicted, params, attempt), path, run_id, name, attempt)
    return mean_scores(run_scores(spark, path, run_id, n), params.rouge_types)


def evaluate_checkpoint(
    examples: DataFrame,
    checkpoint_name: str,
    path: str,
    predictor: Predictor | None = None,
    num_samples: int = SPOT_CHECK_SAMPLES,
    params: EvalParams = EvalParams(),
) -> DataFrame:
    """Spot check of a named checkpoint on a prefix of the test examples."""
    spot_check = replace(params, num_samples=num_samples)
    return evaluate_run(examples, checkpoint_name, path, predictor, spot_check)


def compare_runs(spark: SparkSession, path: str, rouge_types: tuple[str, ...]) -> DataFrame:
    """Mean scores of every run under a path."""
    records = latest_records(_scores_only(read_results(spark, path)))
    return mean_scores(records, rouge_types, ["run_id"])
