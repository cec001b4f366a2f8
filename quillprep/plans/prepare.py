"""From raw splits to an exported training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.operators import packing
from quillprep.operators.pairs import prompt_target_pairs
from quillprep.operators.sampling import sample_per_split
from quillprep.operators.vocabulary import build_vocabulary
from quillprep.params import PrepParams
from quillprep.session import cut_lineage
from quillprep.sources.export import ROWS_PER_FILE, export_training_set


def prepare_pairs(rows: DataFrame, params: PrepParams, check_keys: bool = True) -> DataFrame:
    """Sample each split, then build ``index, prompt, target``; text work on the sample only.

    With ``check_keys`` the job fails where a sampled row's key is missing or not its own.
    """
    sampled = sample_per_split(
        rows, params.split_sizes, params.key_col, params.seed, check_keys
    )
    return prompt_target_pairs(sampled, params)


def train_tokens(tokenized: DataFrame) -> DataFrame:
    """Token strings the vocabulary is built from: prompts and targets of the train split."""
    train = tokenized.filter(F.col("split") == "train")
    return train.select(F.concat("prompt_tokens", "target_tokens").alias("tokens"))


def fit_vocabulary(tokenized: DataFrame, params: PrepParams) -> DataFrame:
    return build_vocabulary(train_tokens(tokenized), params.vocab_size)


def encode_splits(
    pairs: DataFrame, params: PrepParams, vocabulary: DataFrame | None = None
) -> DataFrame:
    """Pairs to ``prompt_ids, target_ids`` within ``max_len``; the vocabulary is built if absent."""
    tokenized = packing.with_tokens(pairs, params)
    if vocabulary is None:
        vocabulary = fit_vocabulary(tokenized, params)
    return packing.encode_examples(tokenized, vocabulary, params, ["split", params.key_col])


def tokenize_splits(
    pairs: DataFrame, params: PrepParams, vocabulary: DataFrame | None = None
) -> DataFrame:
    """Pairs to fixed-length ``input_ids, attention_mask, labels``."""
    return packing.pack(encode_splits(pairs, params, vocabulary), params)


def prepare_training_set(
    rows: DataFrame, path: str, params: PrepParams, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Raw rows to an exported training set in sample order; returns the prepared pairs.

    The pairs are written once: the vocabulary pass, the encoding and an evaluation read them
    instead of sampling again.
    """
    pairs = cut_lineage(prepare_pairs(rows, params))
    export_training_set(encode_splits(pairs, params), path, params, "index", rows_per_file)
    return pairs
