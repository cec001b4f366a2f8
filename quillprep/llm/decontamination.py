"""Benchmark decontamination by greedy string tiling.

Texts become lower-cased words without ASCII punctuation. Seeds are runs of ``min_tile`` words of a
benchmark item, found in a document by Karp-Rabin fingerprints that roll over its words. From equal
seeds, tiling repeatedly marks the longest match whose words no earlier tile holds, on either side,
down to ``min_tile`` words. An item is contained where its tiles cover ``coverage`` of its words; as
tiles may lie in any order, reordered passages are caught.

Seeds are joined where the documents lie: the distinct texts of the benchmark are cut into blocks of at most
``block_words`` words, a block's seeds are broadcast, and what it finds is written before the next block is read and the
broadcast freed. So driver and executors hold one block, whatever the benchmark's size, and documents are not shuffled.
A document whose words are mostly in no item costs one dictionary lookup a word. Of a document with seeds, each item is
taken by itself: it is left out if all its words under shared seeds could not reach ``coverage``, settled at once if the
document holds it whole, and otherwise tiled from runs of seeds, which are followed along diagonals and never listed pair
by pair. So memory follows the text and one item, also where many items share passages.

Null and empty texts, items included, match nothing. Items shorter than ``min_tile`` words are
matched whole. Repeated rows, null ids and copies of an item are rows like any other. An empty table
on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from quillprep.llm.arrow import Lists, filter_rows, map_lists
from quillprep.llm.columns import text_or_empty, unused
from quillprep.llm.ordering import numbered
from quillprep.session import cut_lineage, scratch_path

# ASCII punctuation and control characters become gaps between words.
_GAPS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class TilingParams:
    """``min_tile`` in words; ``coverage`` is the share of an item's words that contains it."""

    min_tile: int = 5
    coverage: float = 0.5
    block_words: int = 1_000_000

    def __post_init__(self) -> None:
        if self.min_tile < 1 or not 0 < self.coverage <= 1 or self.block_words < 1:
            raise ValueError("need min_tile >= 1, 0 < coverage <= 1, block_words >= 1")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_GAPS).split()


def fingerprints(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all runs of ``width`` ids, modulo 2^64; each rolls on by one id."""
    out = np.zeros(max(0, len(ids) - width + 1), np.uint64)
    for k in range(width):
        out = out * _BASE + ids[k : k + len(out)].astype(np.uint64)
    return out


class Block:
    """Items of one block: word numbers, and the seeds of each width as sorted fingerprints."""

    def __init__(self, items: list[tuple[int, list[bytes]]], min_tile: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.words = [np.array([number(w) for w in found], np.int64) for _, found in items]
        self.widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_width: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            if len(w):
                by_width.setdefault(min(min_tile, len(w)), []).append(k)
        for width, members in by_width.items():
            prints = [fingerprints(self.words[k], width) for k in members]
            owner = np.concatenate([np.full(len(p), k) for k, p in zip(members, prints, strict=True)])
            at = np.concatenate([np.arange(len(p)) for p in prints])
            flat = np.concatenate(prints)
            order = np.argsort(flat, kind="stable")
            self.widths[width] = flat[order], owner[order], at[order]

    def matches(self, text: str | None, coverage: float) -> list[tuple[int, float, int]]:
        """``(item number, share covered, tiles)`` of each item the text contains."""
        known = self.vocabulary.get
        ids = np.fromiter((known(w, 0) for w in tokens(text)), np.int64)
        found = []
        for width, (prints, owner, at) in self.widths.items():
            if len(ids) < width:
                continue
            # a seed can only stand where `width` words in a row are known
            runs = np.concatenate([[0], np.cumsum(ids > 0)])
            places = np.flatnonzero(runs[width:] - runs[:-width] == width)
            if not len(places):
                continue
            own = fingerprints(ids, width)[places]
            order = np.argsort(own, kind="stable")
            places = places[order]
            distinct, first, count = np.unique(own[order], return_index=True, return_counts=True)
            low, high = np.searchsorted(prints, distinct, "left"), np.searchsorted(prints, distinct, "right")
            hits = high > low
            if not hits.any():
                continue
            first, count, low, many = first[hits], count[hits], low[hits], (high - low)[hits]
            # the items' seeds that the text has, each once, by item and place in it
            seed = np.repeat(np.arange(len(low)), many)
            which = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            item, start = owner[which], at[which]
            order = np.lexsort((start, item))
            item, start, seed = item[order], start[order], seed[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(item)) + 1, [len(item)]])
            reach = np.minimum(np.diff(start, append=0), width)
            reach[edges[1:] - 1] = width
            most = np.add.reduceat(reach, edges[:-1])  # words under seeds: no tiles can cover more
            for a, b, m in zip(edges[:-1].tolist(), edges[1:].tolist(), most.tolist(), strict=True):
                k = int(item[a])
                if m < coverage * len(self.words[k]):
                    continue
                held = [(s, places[first[g] : first[g] + count[g]]) for s, g in zip(start[a:b].tolist(), seed[a:b].tolist(), strict=True)]
                covered, tiles = tile(self.words[k], ids, held, width)
                if covered >= coverage * len(self.words[k]):
                    found.append((k, covered / len(self.words[k]), tiles))
        return found


def seed_runs(held: list[tuple[int, np.ndarray]], width: int) -> Iterator[tuple[int, int, int]]:
    """``(start, place, words)`` of the longest runs of seeds that follow each other on a diagonal.

    ``held`` has an item's starts in order with the places of their seeds in the text, ascending. Only runs that are
    still going on are kept from one start to the next.
    """
    none = np.zeros(0, np.int64)
    last, begun, at, before = none, none, none, -2  # of open runs: last place, first start, first place; the last start

    def ended(which: np.ndarray) -> Iterator[tuple[int, int, int]]:
        for s, p in zip(begun[which].tolist(), at[which].tolist(), strict=True):
            yield s, p, before - s + width

    for start, places in held:
        if start != before + 1:
            yield from ended(np.ones(len(last), bool))
            last, begun, at = none, none, none
        spot = np.searchsorted(places, last + 1)
        goes_on = np.zeros(len(last), bool)
        inside = spot < len(places)
        goes_on[inside] = places[spot[inside]] == last[inside] + 1
        yield from ended(~goes_on)
        fresh = np.ones(len(places), bool)
        fresh[spot[goes_on]] = False
        new = places[fresh]
        # open runs stay in order of their last place
        last = np.concatenate([last[goes_on] + 1, new])
        begun = np.concatenate([begun[goes_on], np.full(len(new), start)])
        at = np.concatenate([at[goes_on], new])
        order = np.argsort(last, kind="stable")
        last, begun, at, before = last[order], begun[order], at[order], start
    yield from ended(np.ones(len(last), bool))


def _equal_parts(a: np.ndarray, b: np.ndarray, width: int) -> list[tuple[int, int]]:
    """``(offset, length)`` of where two equally long arrays agree over ``width`` or more."""
    if np.array_equal(a, b):
        return [(0, len(a))]
    steps = np.flatnonzero(np.diff(np.concatenate([[0], (a == b).view(np.int8), [0]])))
    return [(i, j - i) for i, j in zip(steps[::2].tolist(), steps[1::2].tolist(), strict=True) if j - i >= width]


def tile(item: np.ndarray, text: np.ndarray, held: list[tuple[int, np.ndarray]], width: int) -> tuple[int, int]:
    """Greedy tiling of one item over one text, from the item's starts with the places of their seeds.

    The longest run becomes a tile; what is left of the others, once words that tiles hold are cut out, goes back, until
    no run is left. Returns the item's words under tiles and the number of tiles.
    """
    n = len(item)
    if len(held) == n - width + 1:
        # a text that holds the item whole has it around a place of its rarest seed
        start, places = min(held, key=lambda h: len(h[1]))
        for p in (places - start).tolist():
            if 0 <= p <= len(text) - n and np.array_equal(text[p : p + n], item):
                return n, 1
    todo: dict[int, list[tuple[int, int]]] = {}
    for s, p, m in seed_runs(held, width):
        # fingerprints may meet by chance
        for offset, length in _equal_parts(item[s : s + m], text[p : p + m], width):
            todo.setdefault(length, []).append((s + offset, p + offset))
    if not todo:
        return 0, 0
    used_item, used_text, tiles = np.zeros(n, bool), np.zeros(len(text), bool), 0
    for m in range(max(todo), width - 1, -1):
        for s, p in sorted(todo.pop(m, ())):
            free = ~(used_item[s : s + m] | used_text[p : p + m])
            if free.all():
                used_item[s : s + m] = used_text[p : p + m] = True
                tiles += 1
                continue
            steps = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
            for a, b in zip(steps[::2].tolist(), steps[1::2].tolist(), strict=True):
                if b - a >= width:
                    todo.setdefault(b - a, []).append((s + a, p + a))
        if used_item.all():
            break
    return int(used_item.sum()), tiles


def _distinct_items(benchmark: DataFrame, params: TilingParams, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """Distinct item texts with their ``key`` and block, ``key, item_id`` of all items, and the number of blocks.

    Words are counted generously, so blocks stay in bounds.
    """
    items = numbered(benchmark.select(F.col(item_col).alias("item_id"), text_or_empty(text_col).alias("text")))
    texts = items.groupBy("text").agg(F.min("row_no").alias("key"))
    size = F.length("text") / 2 + 1
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0.0)).alias("n")).first().n
    count = max(1, -(-int(2 * total) // params.block_words)) if total > params.block_words else 1
    texts = cut_lineage(texts.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count))))
    members = items.join(texts.select("text", "key"), "text").select("key", "item_id")
    return texts, members, count


def _shared_block(texts: DataFrame, number: int, params: TilingParams) -> Broadcast:
    own = texts.filter(F.col("block") == number).select("key", "text").orderBy("key")
    items = [(r.key, tokens(r.text)) for r in own.toLocalIterator()]
    return texts.sparkSession.sparkContext.broadcast(Block(items, params.min_tile))


def _found(texts: DataFrame, shared: Broadcast, coverage: float, columns: str) -> DataFrame:
    """The ``columns`` of ``texts`` with ``key, coverage, tiles`` for each item of the block that a row contains."""
    kept = [f.split()[0] for f in columns.split(", ")]

    def search(batches: Iterator[Lists]) -> Iterator[Lists]:
        block = shared.value
        for batch in batches:
            out: Lists = {c: [] for c in (*kept, "key", "coverage", "tiles")}
            for k, text in enumerate(batch["text"]):
                for number, share, tiles in block.matches(text, coverage):
                    for c in kept:
                        out[c].append(batch[c][k])
                    out["key"].append(block.names[number])
                    out["coverage"].append(share)
                    out["tiles"].append(tiles)
            yield out

    return map_lists(texts, search, f"{columns}, key long, coverage double, tiles int")


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    params: TilingParams = TilingParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, coverage, tiles`` for each document and each item that it contains."""
    spark = docs.sparkSession
    distinct, members, count = _distinct_items(benchmark, params, item_col, item_text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}"
    path = scratch_path(spark, "contained")
    for number in range(count):
        shared = _shared_block(distinct, number, params)
        _found(texts, shared, params.coverage, kind).write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.parquet(path).join(members, "key").select("doc_id", "item_id", "coverage", "tiles")


def clean_documents(docs: DataFrame, benchmark: DataFrame, params: TilingParams = TilingParams()) -> DataFrame:
    """The documents that contain no item, with all their columns.

    Judged row by row where the text lies, so ids need not be unique and nothing is shuffled for a benchmark of one block.
    With more, documents are written once with a number of their own, and those that any block finds are left out.
    """
    distinct, _, count = _distinct_items(benchmark, params, "item_id", "text")
    if count == 1:
        shared = _shared_block(distinct, 0, params)

        def judge(shared=shared, coverage=params.coverage):
            return lambda text: not shared.value.matches(text, coverage)

        return filter_rows(docs, "text", judge)
    (own,) = unused(docs, "row")
    rows = cut_lineage(docs.withColumn(own, F.monotonically_increasing_id()))
    path = scratch_path(docs.sparkSession, "contained")
    for number in range(count):
        shared = _shared_block(distinct, number, params)
        texts = rows.select(F.col(own).alias("row_no"), "text")
        _found(texts, shared, params.coverage, "row_no long").select("row_no").distinct().write.mode("append").parquet(path)
        shared.destroy()
    found = docs.sparkSession.read.parquet(path).withColumnRenamed("row_no", own)
    return rows.join(found, own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
