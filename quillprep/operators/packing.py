"""Tokenized pairs to fixed-length ids, masks and labels under a reserved target budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillprep.functions import arrays, text
from quillprep.operators.encoding import encode
from quillprep.operators.pairs import with_prompt_text
from quillprep.params import PrepParams, template_parts


def with_tokens(pairs: DataFrame, params: PrepParams) -> DataFrame:
    """Replace prompt and target by their token strings; whole texts, no cut."""
    rendered = with_prompt_text(pairs, params)
    return rendered.select(
        *[c for c in pairs.columns if c not in ("prompt", "target")],
        text.token_strings(F.col("prompt_text")).alias("prompt_tokens"),
        text.token_strings(F.col("target")).alias("target_tokens"),
    )


def _tail(params: PrepParams) -> str:
    """What follows the article in a rendered prompt."""
    after = template_parts(params.instruction_template)[-1] or ""
    chat = params.chat
    return after + chat.close + chat.open_left + chat.assistant_role + chat.open_right


def _cut_article(tokens: Column, params: PrepParams) -> Column:
    """Shorten the article alone: keep the tokens after it, cut before them.

    Fails, saying so, where the budget does not hold the tokens after the article.
    """
    keep = F.size(text.token_strings(F.lit(_tail(params))))
    budget = F.lit(params.max_len - params.max_target)
    n = F.size(tokens)
    shortened = F.concat(
        F.slice(tokens, F.lit(1), budget - keep), F.slice(tokens, n - keep + 1, keep)
    )
    fault = F.raise_error("the prompt budget is shorter than what follows the article")
    return F.when(n <= budget, tokens).when(keep <= budget, shortened).otherwise(fault.cast("array<string>"))


def cut_prompt(tokens: Column, params: PrepParams) -> Column:
    """Bring the prompt within its budget by the chosen rule."""
    if params.cut == "article":
        return _cut_article(tokens, params)
    return arrays.cut_prompt(tokens, params.max_len, params.max_target)


def encode_examples(
    tokenized: DataFrame, vocabulary: DataFrame, params: PrepParams, key: list[str]
) -> DataFrame:
    """Token strings to ``prompt_ids, target_ids`` within ``max_len``.

    Both are cut as strings, before the lookup: ids beyond ``max_len`` are never looked up.
    """
    short = tokenized.withColumns(
        {
            "prompt_tokens": cut_prompt(F.col("prompt_tokens"), params),
            "target_tokens": F.slice("target_tokens", 1, params.max_len),
        }
    )
    names = {"prompt_tokens": "prompt_ids", "target_tokens": "target_ids"}
    return cut_targets(encode(short, vocabulary, names, key), params)


def cut_targets(encoded: DataFrame, params: PrepParams) -> DataFrame:
    """Close each target with the end token, within the room its prompt left."""
    cut = arrays.cut_target(F.col("target_ids"), F.col("prompt_ids"), params.eos_id, params.max_len)
    return encoded.withColumn("target_ids", cut)


def pack(examples: DataFrame, params: PrepParams) -> DataFrame:
    """``prompt_ids, target_ids`` to ``input_ids, attention_mask, labels`` of ``max_len``."""
    prompt, target = F.col("prompt_ids"), F.col("target_ids")
    pad = arrays.resolve_pad(params.pad_id, params.eos_id)
    return examples.select(
        *[c for c in examples.columns if c not in ("prompt_ids", "target_ids")],
        arrays.pack_ids(prompt, target, pad, params.max_len).alias("input_ids"),
        arrays.attention_mask(prompt, target, params.max_len).alias("attention_mask"),
        arrays.label_ids(prompt, target, params.max_len).alias("labels"),
    )


def tokenize_pairs(pairs: DataFrame, tokenize, params: PrepParams) -> DataFrame:
    """Pairs to ``prompt_ids, target_ids`` by a caller's column function from text to ids.

    Cut, end token and padding follow ``params``: give the model's own ``eos_id`` and ``pad_id``.
    """
    rendered = with_prompt_text(pairs, params)
    encoded = rendered.select(
        *[c for c in pairs.columns if c not in ("prompt", "target")],
        tokenize(F.col("prompt_text")).alias("prompt_ids"),
        tokenize(F.col("target")).alias("target_ids"),
    )
    short = encoded.withColumn("prompt_ids", arrays.cut_prompt(F.col("prompt_ids"), params.max_len, params.max_target))
    return cut_targets(short, params)
