"""Byte-level subwords by merge ranks: a given vocabulary, ids and back without an unknown token.

A vocabulary file holds a token a line, its bytes in base64 and its id, which is also its merge rank. Texts
are cut into pieces by a pattern in the JVM; a piece starts as its bytes, and the neighbours whose union has the lowest
rank are merged until none is left. Every byte is a token, so every text has ids, and ids give back the text.
Vocabularies are used as given and never trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillprep.functions.batches import parts
from quillprep.operators.vocabulary import BROADCAST_BYTES, BROADCAST_TOKENS

# Fixed value: how texts are cut before the merges. (?U) reads \s as any Unicode white space.
PIECES = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

IDS = T.ArrayType(T.IntegerType())

# Pieces that a task remembers; it starts anew when it has seen as many.
REMEMBERED = 1 << 18


@dataclass(frozen=True)
class Subwords:
    """A broadcast vocabulary: each token's bytes, in order of their ids."""

    tokens: Broadcast
    size: int


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``token`` (its bytes) and ``token_id`` of a vocabulary file."""
    parts = F.split(F.col("value"), " ")
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.select(F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("token_id"))


def load_subwords(spark: SparkSession, path: str) -> Subwords:
    """Broadcast a vocabulary file, once its size has been measured and its ids and bytes are complete."""
    table = read_vocabulary(spark, path)
    n, size, lowest, highest, distinct, octets = table.agg(
        F.count("*"),
        F.coalesce(F.sum(F.octet_length("token")), F.lit(0)),
        F.min("token_id"),
        F.max("token_id"),
        F.count_distinct("token"),
        F.count_if(F.octet_length("token") == 1),
    ).head()
    if n > BROADCAST_TOKENS or size > BROADCAST_BYTES:
        raise ValueError(f"a vocabulary of {n} tokens and {size} bytes is too large to broadcast")
    if (lowest, highest, distinct, octets) != (0, n - 1, n, 256):
        raise ValueError("ids must run from 0 without a gap, tokens must differ and have all 256 bytes among them")
    rows = sorted(table.select("token_id", "token").collect())
    tokens = [bytes(token) for _, token in rows]
    return Subwords(spark.sparkContext.broadcast(pa.array(tokens, pa.binary())), n)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece. Neighbours are kept in a heap by rank and place, so a long piece takes n log n steps."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = ranks.get
    heap = [(r, at, at + 1, at + 2) for at in range(n - 1) if (r := pair(piece[at : at + 2])) is not None]
    heapify(heap)
    gone = bytearray(n + 1)

    def offer(left: int, middle: int, right: int) -> None:
        rank = pair(piece[left:right])
        if rank is not None:
            heappush(heap, (rank, left, middle, right))

    while heap:
        _, left, middle, right = heappop(heap)
        if gone[left] or gone[middle] or after[left] != middle or after[middle] != right:
            continue  # one of the two has been merged with another since
        gone[middle] = 1
        after[left] = right
        if right < n:
            before[right] = left
            offer(left, right, after[right])
        if left:
            offer(before[left], left, right)
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


def text_pieces(text: Column) -> Column:
    """What a text is cut into before the merges; together the pieces are the text."""
    return F.regexp_extract_all(text, F.lit(PIECES), 0)


def subword_ids(text: Column, vocabulary: Subwords) -> Column:
    """Ids of a text; null for null. A task merges each distinct piece once."""
    shared = vocabulary.tokens

    @F.arrow_udf(IDS)
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = {token: number for number, token in enumerate(shared.value.to_pylist())}
        known: dict[str, list[int]] = {}
        for (lists,) in chain.from_iterable(map(parts, batches)):
            flat = lists.flatten().dictionary_encode()
            if len(known) > REMEMBERED:
                known.clear()
            ids = []
            for piece in flat.dictionary.to_pylist():
                if piece not in known:
                    known[piece] = merge(piece.encode(), ranks)
                ids.append(known[piece])
            yield _spread(lists, flat.indices.to_numpy(), ids)

    return ids_of(text_pieces(text))


def _spread(lists: pa.ListArray, codes: np.ndarray, ids: list[list[int]]) -> pa.Array:
    """For each row the ids of its pieces, which ``codes`` number row by row, one after another."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for own in ids for i in own), np.int32, int(sizes.sum()))
    begin, length = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
    ends = np.concatenate([[0], np.cumsum(length)])
    values = flat[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])]
    pieces = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    edges = ends[np.concatenate([[0], np.cumsum(pieces)])]
    nulls = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, pa.int32()), mask=nulls)


def subword_text(ids: Column, vocabulary: Subwords) -> Column:
    """The text that ids stand for. Ids beyond the vocabulary, as of end tokens, are passed over.

    Bytes that are no UTF-8, as where ids were cut inside a character, become the replacement character.
    """
    shared, size = vocabulary.tokens, vocabulary.size

    @F.arrow_udf(T.StringType())
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (lists,) in chain.from_iterable(map(parts, batches)):
            flat = lists.flatten()
            known = pc.if_else(pc.and_(pc.less(flat, size), pc.greater_equal(flat, 0)), flat, pa.scalar(None, flat.type))
            found = pc.fill_null(shared.value.take(known), b"")
            # the tokens' bytes lie one after another, so those of a row are one stretch
            starts = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1]
            octets = memoryview(found.buffers()[2] or b"")
            rows = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            edges = starts[rows].tolist()
            texts = [str(octets[a:b], "utf-8", "replace") for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return text_of(ids)


def subword_usage(texts: DataFrame, vocabulary: Subwords, text_col: str = "text") -> DataFrame:
    """``token_id, uses`` of each subword that occurs; counts combine before the shuffle."""
    ids = texts.select(F.explode(subword_ids(F.col(text_col), vocabulary)).alias("token_id"))
    return ids.groupBy("token_id").agg(F.count("*").alias("uses"))
