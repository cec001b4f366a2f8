import random
from collections import Counter

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from quillprep.functions import rouge
from quillprep.functions.porter import stem
from quillprep.operators.scoring import (
    batch_predictor,
    lead_prediction,
    mean_scores,
    score_records,
    with_scores,
)
from quillprep.params import EvalParams

PLAIN = EvalParams(use_stemmer=False)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


def plain_scores(prediction, reference):
    p, r = prediction.split(), reference.split()

    def f(matches, n, m):
        return 2 * matches / (n + m) if n + m else 0.0

    def overlap(n):
        grams = [Counter(zip(*[s[i:] for i in range(n)])) for s in (p, r)]
        return sum((grams[0] & grams[1]).values())

    return (
        f(overlap(1), len(p), len(r)),
        f(overlap(2), max(len(p) - 1, 0), max(len(r) - 1, 0)),
        f(plain_lcs(p, r), len(p), len(r)),
    )


def scored(spark, rows, params=PLAIN):
    df = spark.createDataFrame(
        [(i, p, r) for i, (p, r) in enumerate(rows)], "i int, prediction string, reference string"
    )
    return [tuple(x.scores) for x in with_scores(df, params).orderBy("i").collect()]


@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=90))
def test_lcs_matches_dynamic_programme(a, b):
    assert rouge.lcs_length(a, b) == rouge.lcs_length(b, a) == plain_lcs(a, b)


def test_named_cases(spark):
    got = scored(
        spark,
        [
            ("the cat sat", "the cat sat"),
            ("a b", "c d"),
            ("", ""),
            ("", "a"),
            ("a a a b", "a a c"),
            ("word", "word"),
            ("The CAT, sat!", "the cat sat"),
            (None, "a"),
        ],
    )
    assert got[0] == (1, 1, 1) and got[1] == got[2] == got[3] == got[7] == (0, 0, 0)
    assert got[4] == pytest.approx((4 / 7, 2 / 5, 4 / 7))
    assert got[5] == (1, 0, 1) and got[6] == (1, 1, 1)


def test_random_pairs_match_brute_force_and_are_symmetric(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 2, 5, 40, 300])))
    rows = [(text(), text()) for _ in range(300)]
    got = scored(spark, rows)
    assert got == [pytest.approx(plain_scores(p, r)) for p, r in rows]
    assert scored(spark, [(r, p) for p, r in rows]) == [pytest.approx(s) for s in got]


def test_single_metric_and_small_batches(spark):
    rows = [("a b c", "b c"), ("x", "y"), ("a b", "a b")] * 40
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        whole = scored(spark, rows)
        for at, kind in enumerate(PLAIN.rouge_types):
            params = EvalParams(use_stemmer=False, rouge_types=(kind,))
            assert scored(spark, rows, params) == [(s[at],) for s in whole]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stemmer_in_scores(spark):
    assert scored(spark, [("running dogs", "runs dog")], EvalParams())[0] == (1, 1, 1)
    assert scored(spark, [("was", "wa")], EvalParams())[0] == (0, 0, 0)  # too short to stem
    assert scored(spark, [("connection", "connected")], EvalParams())[0] == (1, 0, 1)


# Published examples of the algorithm's steps.
EXAMPLES = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre
plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size
hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi
sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit
digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
generalizations gener oscillators oscil""".split()


@pytest.mark.parametrize("word,want", list(zip(EXAMPLES[::2], EXAMPLES[1::2])))
def test_published_stems(word, want):
    assert stem(word) == want


def test_stem_tokens(spark):
    df = spark.createDataFrame([(["ponies", "was", "été"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(rouge.stem_tokens(F.col("t"))).collect()] == [
        ["poni", "was", "été"],
        [],
    ]


def test_lead_and_means(spark):
    df = spark.createDataFrame([("One two, THREE four",), ("",)], "a string")
    got = [r[0] for r in df.select(lead_prediction(F.col("a"), 3)).collect()]
    assert got == ["one two three", ""]
    none = spark.createDataFrame([], "scores struct<rouge1:double,rouge2:double,rougeL:double>")
    assert tuple(mean_scores(none).head()) == (0.0, 0.0, 0.0)


def test_batch_predictor(spark):
    predict = batch_predictor(lambda: lambda prompts: [p.upper() + " " for p in prompts])
    df = spark.createDataFrame([("a",), ("b",)], "p string")
    assert [r[0] for r in df.select(predict(F.col("p"))).collect()] == ["A", "B"]


def test_record_shape(spark):
    df = spark.createDataFrame(
        [("r", 3, "a", "a")], "run_id string, index long, prediction string, reference string"
    )
    record = score_records(df, PLAIN, attempt=2).head().asDict(recursive=True)
    assert record == {
        "run_id": "r", "index": 3, "attempt": 2, "prediction": "a", "reference": "a",
        "scores": {"rouge1": 1.0, "rouge2": 0.0, "rougeL": 1.0},
    }
