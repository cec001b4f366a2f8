"""Predictions and score records."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillprep.functions import rouge
from quillprep.params import ROUGE_TYPES, EvalParams


def lead_prediction(article: Column, n: int, pattern: str = "english") -> Column:
    """Baseline summary: the first ``n`` scoring tokens of the article."""
    return F.array_join(F.slice(rouge.scoring_tokens(article, pattern), 1, n), " ")


def batch_predictor(
    factory: Callable[[], Callable[[list[str]], Iterable[str]]],
) -> Callable[[Column], Column]:
    """Column function from prompt to text by the caller's model, built once per task.

    ``factory()`` returns a function from a list of prompts to as many texts.
    """

    @F.pandas_udf(T.StringType())
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for prompts in batches:
            yield pd.Series(list(model(prompts.tolist())), index=prompts.index).str.strip()

    return predict


def predict_by_budget(
    prompts: DataFrame,
    factory: Callable[[], Callable[[list[str]], Iterable[str]]],
    budget: int,
    length: Callable[[str], int] = len,
    pool: int = 4_096,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Rows with ``prompt`` to rows with ``prediction`` in its place, in batches that fit a model's memory.

    A task takes ``pool`` rows at a time, sorts them by ``length`` and cuts them where the longest prompt times the
    number of prompts would pass ``budget``; a prompt beyond it goes alone. Rows come back in their order. ``profile``
    asks for executors of their own kind, as with an accelerator, for this stage.
    """
    if budget < 1 or pool < 1:
        raise ValueError("budget and pool must be at least 1")
    fields = [f if f.name != "prompt" else T.StructField("prediction", T.StringType()) for f in prompts.schema.fields]
    at = prompts.columns.index("prompt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, pool):
                part = batch.slice(start, pool)
                texts = part.column(at).to_pylist()
                found: list[str | None] = [None] * len(texts)
                for group in budget_batches([0 if t is None else length(t) for t in texts], budget):
                    given = [k for k in group if texts[k] is not None]
                    answers = list(model([texts[k] for k in given])) if given else []
                    if len(answers) != len(given):
                        raise ValueError(f"the model gave {len(answers)} texts for {len(given)} prompts")
                    for k, answer in zip(given, answers, strict=True):
                        found[k] = None if answer is None else answer.strip()
                columns = [*part.columns]
                columns[at] = pa.array(found, pa.string())
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return prompts.mapInArrow(run, T.StructType(fields), profile=profile)


def budget_batches(lengths: list[int], budget: int) -> Iterator[list[int]]:
    """Places of ``lengths``, longest first, in batches whose longest times their number stays within ``budget``."""
    batch: list[int] = []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        if batch and lengths[batch[0]] * (len(batch) + 1) > budget:
            yield batch
            batch = []
        batch.append(k)
    if batch:
        yield batch


def with_scores(pairs: DataFrame, params: EvalParams) -> DataFrame:
    """Add ``scores``, a struct of F-measures, from ``prediction`` and ``reference``."""
    kinds = params.rouge_types
    tokens = pairs.withColumns(
        {
            "_predicted": rouge.scoring_tokens(F.col("prediction"), params.pattern),
            "_referenced": rouge.scoring_tokens(F.col("reference"), params.pattern),
        }
    )
    counted = tokens.withColumns(
        {
            "_matches": rouge.overlaps(
                F.col("_predicted"), F.col("_referenced"), kinds, params.use_stemmer
            ),
            "_n_predicted": F.size("_predicted"),
            "_n_referenced": F.size("_referenced"),
        }
    ).drop("_predicted", "_referenced")

    def measure(kind: str) -> Column:
        grams = [F.col("_n_predicted"), F.col("_n_referenced")]
        if kind == "rouge2":
            grams = [F.greatest(n - 1, F.lit(0)) for n in grams]
        return rouge.f_measure(F.col("_matches")[kind], *grams).alias(kind)

    scores = F.struct(*[measure(kind) for kind in kinds])
    return counted.withColumn("scores", scores).drop("_matches", "_n_predicted", "_n_referenced")


def score_records(predicted: DataFrame, params: EvalParams, attempt: int = 0) -> DataFrame:
    """``run_id, index, prediction, reference`` to score records."""
    return with_scores(
        predicted.select("run_id", "index", "prediction", "reference"), params
    ).select(
        "run_id",
        "index",
        F.lit(attempt).alias("attempt"),
        "prediction",
        "reference",
        "scores",
    )


def mean_scores(
    records: DataFrame, rouge_types: tuple[str, ...] = ROUGE_TYPES, by: list[str] | None = None
) -> DataFrame:
    """Mean of each metric; 0.0 each without a record."""
    means = [F.coalesce(F.avg(F.col("scores")[k]), F.lit(0.0)).alias(k) for k in rouge_types]
    return records.groupBy(*(by or [])).agg(*means)
