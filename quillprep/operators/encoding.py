"""Token strings to ids and back; callers' own tokenizers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillprep.functions.batches import parts
from quillprep.functions.text import MARKER_PATTERN
from quillprep.operators.vocabulary import RESERVED, UNK_ID, Lookup, broadcast_lookup
from quillprep.session import cut_lineage

IDS = T.ArrayType(T.IntegerType())


def _like(lists: pa.Array, values: pa.Array) -> pa.Array:
    """New values in the list shape of an array."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def lookup_ids(tokens: Column, lookup: Lookup) -> Column:
    """Ids of a token array through a broadcast vocabulary: no shuffle, a batch at a time.

    Each distinct token of a batch is looked up once, by Arrow.
    """
    known = lookup.tokens

    @F.arrow_udf(IDS)
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (lists,) in chain.from_iterable(map(parts, batches)):
            flat = lists.flatten().dictionary_encode()
            ids = pc.fill_null(pc.index_in(flat.dictionary, value_set=known.value), UNK_ID)
            yield _like(lists, pc.fill_null(ids.take(flat.indices), UNK_ID))

    return ids_of(tokens)


def join_ids(
    rows: DataFrame, vocabulary: DataFrame, columns: dict[str, str], key: list[str], written: bool = False
) -> DataFrame:
    """The same for a vocabulary too large to broadcast: join each token, regroup by row.

    All columns are exploded together, so there is one join with the vocabulary and one with the
    rows, which are written first and computed once, unless they are ``written`` already. AQE splits
    the partitions of frequent tokens. Rows without tokens keep an empty array.
    """
    rows = rows if written else cut_lineage(rows)
    return _joined_lists(rows, vocabulary, columns, key, "token", F.coalesce("token_id", F.lit(UNK_ID)), IDS)


def _joined_lists(
    rows: DataFrame,
    vocabulary: DataFrame,
    columns: dict[str, str],
    key: list[str],
    by: str,
    value: Column,
    kind: T.ArrayType,
) -> DataFrame:
    """Replace each element of array columns by ``value`` of the vocabulary row it meets on ``by``.

    Elements for which ``value`` is null are left out.
    """

    def elements(number: int, source: str) -> Column:
        return F.transform(source, lambda x, i: F.struct(F.lit(number).alias("_col"), i.alias("_pos"), x.alias(by)))

    lists = [F.coalesce(elements(n, source), F.array()) for n, source in enumerate(columns)]
    tagged = F.explode(F.concat(*lists))
    each = rows.select(*key, tagged.alias("_e")).select(*key, "_e.*")
    met = each.join(vocabulary, by, "left").withColumn("_value", value)
    met = met.filter(F.col("_value").isNotNull())
    grouped = _packed_ids(met, columns, key) if kind == IDS else _sorted_values(met, columns, key)
    empty = {target: F.coalesce(target, F.array().cast(kind)) for target in columns.values()}
    return rows.join(grouped, key, "left").withColumns(empty)


def _sorted_values(met: DataFrame, columns: dict[str, str], key: list[str]) -> DataFrame:
    """Values regrouped by row, those of each column in order of their places."""
    pairs = lambda n: F.array_sort(F.collect_list(F.when(F.col("_col") == n, F.struct("_pos", "_value"))))
    lists = [
        F.transform(pairs(n), lambda x: x["_value"]).alias(target) for n, target in enumerate(columns.values())
    ]
    return met.groupBy(*key).agg(*lists)


def _packed_ids(met: DataFrame, columns: dict[str, str], key: list[str]) -> DataFrame:
    """The same for ids: column, place and id are one long, so that longs are collected and sorted, not structs.

    Five bits hold the column and 26 the place; no row holds as many tokens.
    """
    head = F.shiftleft(F.col("_col").cast("long"), 58).bitwiseOR(F.shiftleft(F.col("_pos").cast("long"), 32))
    packed = head.bitwiseOR(F.col("_value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    grouped = met.groupBy(*key).agg(F.sort_array(F.collect_list(packed)).alias("_packed"))

    def own(number: int) -> Column:
        mine = F.filter("_packed", lambda x: F.shiftright(x, 58) == number)
        return F.transform(mine, lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))

    return grouped.select(*key, *[own(n).alias(target) for n, target in enumerate(columns.values())])


def encode(
    rows: DataFrame, vocabulary: DataFrame, columns: dict[str, str], key: list[str]
) -> DataFrame:
    """Replace token-array columns by id arrays: ``columns`` maps old names to new."""
    lookup = broadcast_lookup(rows.sparkSession, vocabulary)
    if lookup is None:
        return join_ids(rows, vocabulary, columns, key).drop(*columns)
    return rows.withColumns(
        {target: lookup_ids(F.col(source), lookup) for source, target in columns.items()}
    ).drop(*columns)


def decode_ids(ids: Column, lookup: Lookup) -> Column:
    """Ids to text: reserved tokens and turn markers dropped, one space between tokens."""
    known = lookup.tokens

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def tokens_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # special tokens are null in the table, and array_join passes nulls over
        special = pc.match_substring_regex(known.value, f"^(?:{MARKER_PATTERN})$")
        special = pc.or_(special, pc.is_in(known.value, value_set=pa.array(RESERVED)))
        plain = pc.if_else(special, pa.scalar(None, pa.string()), known.value)
        for (lists,) in chain.from_iterable(map(parts, batches)):
            yield _like(lists, plain.take(lists.flatten()))

    return F.array_join(tokens_of(ids), " ")


def join_text(
    rows: DataFrame, vocabulary: DataFrame, columns: dict[str, str], key: list[str]
) -> DataFrame:
    """Decoding for a vocabulary too large to broadcast: join each id, regroup by row."""
    token = F.col("token")
    plain = F.when(~(token.rlike(f"^(?:{MARKER_PATTERN})$") | token.isin(*RESERVED)), token)
    texts = T.ArrayType(T.StringType())
    joined = _joined_lists(cut_lineage(rows), vocabulary, columns, key, "token_id", plain, texts)
    return joined.withColumns({target: F.array_join(target, " ") for target in columns.values()})


def decode(
    rows: DataFrame, vocabulary: DataFrame, columns: dict[str, str], key: list[str]
) -> DataFrame:
    """Replace id-array columns by texts, whatever the vocabulary's size."""
    lookup = broadcast_lookup(rows.sparkSession, vocabulary)
    if lookup is None:
        return join_text(rows, vocabulary, columns, key).drop(*columns)
    return rows.withColumns(
        {target: decode_ids(F.col(source), lookup) for source, target in columns.items()}
    ).drop(*columns)


def custom_tokenizer(factory: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Callable:
    """Column function from text to ids by the caller's tokenizer, built once per task.

    The tokenizer gets the texts of a batch and returns their ids, a list for each text.
    """

    @F.pandas_udf(IDS)
    def encode_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = factory()
        for texts in batches:
            yield pd.Series(list(tokenize(texts.tolist())), dtype=object)

    return encode_text
