"""ROUGE columns: scoring tokens, clipped n-gram overlap, longest common subsequence.

Both token arrays of a pair stand in one row, so scoring needs no shuffle: one Arrow batch
function counts n-grams for all its rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from quillprep.functions.batches import parts
from quillprep.functions.porter import stem
from quillprep.params import SCORE_PATTERNS

# Tokens shorter than this are not stemmed.
STEM_MIN_CHARS = 4


def scoring_tokens(text: Column, pattern: str) -> Column:
    """Lowercased tokens, before stemming; none for a NULL text."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(SCORE_PATTERNS[pattern]), F.lit(0))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def _stems(words: pa.Array) -> pa.Array:
    return pa.array(
        [stem(w) if len(w) >= STEM_MIN_CHARS else w for w in words.to_pylist()], pa.string()
    )


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem a token array, each distinct token of a batch once."""
    for (lists,) in chain.from_iterable(map(parts, batches)):
        encoded = lists.flatten().dictionary_encode()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        stems = _stems(encoded.dictionary).take(encoded.indices)
        yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), stems)


def _codes(left: pa.Array, right: pa.Array, use_stemmer: bool) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' tokens as integers, equal where the (stemmed) tokens are equal."""
    flat = [side.flatten() for side in (left, right)]
    encoded = pa.concat_arrays(flat).dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    if use_stemmer:
        stems = _stems(encoded.dictionary).dictionary_encode()
        codes = stems.indices.to_numpy().astype(np.int64)[codes]
    return codes[: len(flat[0])], codes[len(flat[0]) :]


def _bigrams(codes: np.ndarray, rows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring codes of the same row as one integer, and their rows."""
    together = rows[1:] == rows[:-1]
    return codes[:-1][together] * span + codes[1:][together], rows[1:][together]


def _clipped_overlap(
    left: np.ndarray, left_rows: np.ndarray, right: np.ndarray, right_rows: np.ndarray, n: int
) -> np.ndarray:
    """Per row, the sum over grams of the smaller of the two counts."""
    span = int(max(left.max(initial=0), right.max(initial=0))) + 1
    a, a_count = np.unique(left_rows * span + left, return_counts=True)
    b, b_count = np.unique(right_rows * span + right, return_counts=True)
    both, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    smaller = np.minimum(a_count[at_a], b_count[at_b])
    return np.bincount(both // span, weights=smaller, minlength=n).astype(np.int32)


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, one bit per token of the shorter side.

    Bit-vector recurrence of Hyyro (2004): a zero bit marks a position of the shorter side
    where the length grows. Tokens the shorter side lacks change nothing and are skipped.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    masks: dict = {}
    for i, token in enumerate(short):
        masks[token] = masks.get(token, 0) | 1 << i
    full = (1 << len(short)) - 1
    row = full
    for token in long:
        mask = masks.get(token)
        if mask:
            matched = row & mask
            row = ((row + matched) | (row - matched)) & full
    return len(short) - row.bit_count()


def _overlaps(left: pa.Array, right: pa.Array, rouge_types, use_stemmer: bool) -> pa.Array:
    n = len(left)
    a, b = _codes(left, right, use_stemmer)
    rows = [pc.list_parent_indices(side).to_numpy().astype(np.int64) for side in (left, right)]
    found = []
    for kind in rouge_types:
        if kind == "rouge1":
            found.append(_clipped_overlap(a, rows[0], b, rows[1], n))
        elif kind == "rouge2":
            span = int(max(a.max(initial=0), b.max(initial=0))) + 1
            grams_a, rows_a = _bigrams(a, rows[0], span)
            grams_b, rows_b = _bigrams(b, rows[1], span)
            codes = np.unique(np.concatenate([grams_a, grams_b]), return_inverse=True)[1]
            split = len(grams_a)
            found.append(_clipped_overlap(codes[:split], rows_a, codes[split:], rows_b, n))
        else:
            at_a, at_b = (np.searchsorted(r, np.arange(n + 1)) for r in rows)
            xs, ys = a.tolist(), b.tolist()
            pairs = (
                lcs_length(xs[at_a[i] : at_a[i + 1]], ys[at_b[i] : at_b[i + 1]])
                for i in range(n)
            )
            found.append(np.fromiter(pairs, np.int32, n))
    return pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in found], list(rouge_types))


def overlaps(prediction: Column, reference: Column, rouge_types, use_stemmer: bool) -> Column:
    """Matches per metric of two token arrays, as ``struct<rouge1 int, ...>``."""
    fields = ", ".join(f"{kind}: int" for kind in rouge_types)

    @F.arrow_udf(f"struct<{fields}>")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in chain.from_iterable(parts(*sides) for sides in batches):
            yield _overlaps(left, right, rouge_types, use_stemmer)

    return count(prediction, reference)


def f_measure(matches: Column, predicted: Column, referenced: Column) -> Column:
    """2PR/(P+R) from counts; 0 without a match."""
    both = predicted + referenced
    return F.when(both > 0, 2.0 * matches / both).otherwise(F.lit(0.0))
