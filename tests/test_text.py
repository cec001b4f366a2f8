import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillprep.functions import text
from quillprep.operators.pairs import prompt_target_pairs, render_conversations, with_prompt_text
from quillprep.params import ChatFormat, PrepParams, template_parts

WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


def one_column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_whitespace_is_what_python_takes_for_it(spark):
    code_points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = one_column(spark, [f"a{chr(c)}b" for c in code_points], text.clean_whitespace)
    assert got == [re.sub(r"\s+", " ", f"a{chr(c)}b") for c in code_points]


CASES = [
    "",
    " ",
    "a",
    " a  b\t\nc ",
    "a \u001f\u0085b　",
    "  \n x   y\n\nz\t",
    WHITESPACE + "mid" + WHITESPACE + "end" + WHITESPACE,
    "a" + " " * 20_000 + "b",
]


def test_clean_and_strip_edge_cases(spark):
    assert one_column(spark, CASES, text.clean_whitespace) == [
        re.sub(r"\s+", " ", c).strip() for c in CASES
    ]
    assert one_column(spark, CASES, text.strip_edges) == [c.strip() for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from(WHITESPACE + "ab.é"), max_size=40), min_size=50, max_size=80))
def test_clean_and_strip_random(spark, values):
    assert one_column(spark, values, text.clean_whitespace) == [
        re.sub(r"\s+", " ", v).strip() for v in values
    ]
    assert one_column(spark, values, text.strip_edges) == [v.strip() for v in values]


def test_article_is_inserted_unchanged(spark):
    articles = ["has {article} inside", "$1 and \\ and \\1", "{} {{x}}"]
    params = PrepParams(instruction_template="Do {{this}}:\n{article}\nEnd. {article}")
    rows = spark.createDataFrame(
        [(str(i), a, " s\nt \n") for i, a in enumerate(articles)],
        "id string, article string, highlights string",
    )
    got = prompt_target_pairs(rows, params).orderBy("id").collect()
    assert [r.prompt for r in got] == [
        params.instruction_template.format(article=a) for a in articles
    ]
    assert {r.target for r in got} == {"s\nt"}


@pytest.mark.parametrize("template", ["no field", "{other}", "{article!r}", "{0}"])
def test_bad_templates(template):
    with pytest.raises(ValueError):
        template_parts(template)


def test_chat_rendering(spark):
    pairs = spark.createDataFrame([("1", "ask", "say")], "id string, prompt string, target string")
    chat = ChatFormat("[", "]", "[/]", "model")
    got = with_prompt_text(pairs, PrepParams(chat=chat, system_prompt="rules")).head()
    assert got.prompt_text == "[system]rules[/][user]ask[/][model]"


def test_conversations_in_turn_order(spark):
    turns = spark.createDataFrame(
        [(1, 2, "user", "c"), (1, 0, "system", "a"), (2, 0, "user", "x"), (1, 10, "assistant", "d")],
        "conv_id long, turn long, role string, text string",
    ).repartition(4)
    chat = ChatFormat("<", ">", ";", "assistant")
    got = {r.conv_id: r.chat for r in render_conversations(turns, chat, True).collect()}
    assert got == {1: "<system>a;<user>c;<assistant>d;<assistant>", 2: "<user>x;<assistant>"}
