"""Substring deduplication with difference-cover anchors.

A window of ``window`` words is removed where a document with a smaller id has it too. Hashing every
window of the corpus is not needed: take the positions whose remainder modulo ``period`` lies in a
difference cover. For any two positions some shift of less than ``period`` brings both into the
cover, so two equal windows share an anchor of ``window - period + 1`` words at a cover position of
either document. Only anchors, three of seven positions, are compared over the corpus; windows
are then hashed where they hold an anchor of another document, and compared the same way.

Rows are compared with the smallest and largest id that has their hash, never with each other, so a
passage in thousands of documents costs a row each. Hashes are 64 bits of words' XXH64.

Whether a window goes depends on its words and the row's id alone. So hashes are gathered by id, and
rows without one, which count as larger than every id, by a hash of their text.

Defined results: null and empty texts have no words; texts under ``window`` words keep all. Windows
that only rows of equal id, or without one, share stay. Repeated rows are rows like any other. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from quillprep.llm.arrow import Lists, map_lists

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
LAST = (1 << 63) - 1
_CACHED_WORDS = 1 << 18


@dataclass(frozen=True)
class CoverParams:
    """Every remainder modulo ``period`` must be a difference of two members of ``cover``."""

    window: int = 13
    period: int = 7
    cover: tuple[int, ...] = (0, 1, 3)

    def __post_init__(self) -> None:
        if not 1 <= self.period <= self.window:
            raise ValueError("need 1 <= period <= window")
        differences = {(a - b) % self.period for a in self.cover for b in self.cover}
        if differences != set(range(self.period)) or not all(0 <= c < self.period for c in self.cover):
            raise ValueError("cover is no difference cover of period")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


class WordHashes(dict):
    """XXH64 of words; a cache, emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(hashes: np.ndarray, width: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``width`` words from each start; from every position by default."""
    if starts is None:
        starts = np.arange(max(0, len(hashes) - width + 1))
    out = np.zeros(len(starts), np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[starts + k]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def anchor_starts(count: int, params: CoverParams) -> np.ndarray:
    """Cover positions of a text of ``count`` words, in order; none if no window fits."""
    if count < params.window:
        return np.zeros(0, np.int64)
    here = np.zeros(params.period, bool)
    here[list(params.cover)] = True
    at = np.arange(count - params.anchor + 1)
    return at[here[at % params.period]]


def covered_by(starts: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which of ``count`` positions lie in ``[start, start + width)`` of any start."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _rows(parts: list[tuple[int | None, int, np.ndarray]]) -> Lists:
    """``hash, doc, alone`` rows from ``(doc_id, k, hashes)`` of documents; equal hashes of one once.

    ``alone`` is ``k`` of a row without an id and null elsewhere, where ``k`` is the id: a column of
    nulls takes next to nothing in a shuffle of one row for each hash.
    """
    parts = [(doc, k, np.unique(h)) for doc, k, h in parts]
    sizes = [len(h) for _, _, h in parts]
    named = np.repeat(np.array([doc is not None for doc, _, _ in parts], bool), sizes)
    k = np.repeat(np.array([k for _, k, _ in parts], np.int64), sizes)
    return {
        "hash": np.concatenate([h for _, _, h in parts] or [np.zeros(0, np.int64)]),
        "doc": np.where(named, k, LAST),
        "alone": pa.array(k, pa.int64(), mask=named),
    }


def _compared(rows: DataFrame, smaller_only: bool) -> DataFrame:
    """``k, hashes``: those that another id has, or one with a smaller id, gathered by row."""
    same = Window.partitionBy("hash")
    kept = rows.withColumn("low", F.min("doc").over(same))
    if smaller_only:
        kept = kept.filter("low < doc")
    else:
        kept = kept.withColumn("high", F.max("doc").over(same)).filter("low < high")
    return kept.groupBy(F.coalesce("alone", "doc").alias("k")).agg(F.collect_set("hash").alias("hashes"))


def remove_repeats(
    docs: DataFrame,
    params: CoverParams = CoverParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if wanted, ``kept``: what is left, joined by spaces."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("k"),
        F.col(text_col).alias("text"),
    )

    def anchors(batches: Iterator[Lists]) -> Iterator[Lists]:
        memo = WordHashes()
        for b in batches:
            out = []
            for doc, k, text in zip(b["doc_id"], b["k"], b["text"], strict=True):
                hashes = memo.of(split_words(text))
                out.append((doc, k, window_hashes(hashes, params.anchor, anchor_starts(len(hashes), params))))
            yield _rows(out)

    def windows(batches: Iterator[Lists]) -> Iterator[Lists]:
        memo = WordHashes()
        for b in batches:
            out = []
            for doc, k, text, shared in zip(b["doc_id"], b["k"], b["text"], b["hashes"], strict=True):
                hashes = memo.of(split_words(text))
                starts = anchor_starts(len(hashes), params)
                starts = starts[np.isin(window_hashes(hashes, params.anchor, starts), np.array(shared, np.int64))]
                # windows that hold the anchor start up to period - 1 words before it
                near = covered_by(np.maximum(starts - params.period + 1, 0), params.period, len(hashes) + params.period)
                at = np.flatnonzero(near[: len(hashes) - params.window + 1])
                out.append((doc, k, window_hashes(hashes, params.window, at)))
            yield _rows(out)

    def removed(batches: Iterator[Lists]) -> Iterator[Lists]:
        memo = WordHashes()
        for b in batches:
            out = {"doc_id": b["doc_id"], "n_words": [], "n_removed": [], "kept_sha256": []}
            if with_text:
                out["kept"] = []
            for text, seen in zip(b["text"], b["hashes"], strict=True):
                found = split_words(text)
                left = found
                if seen:
                    every = window_hashes(memo.of(found), params.window)
                    gone = covered_by(np.flatnonzero(np.isin(every, np.array(seen, np.int64))), params.window, len(found))
                    left = [w for w, g in zip(found, gone.tolist(), strict=True) if not g]
                kept = b" ".join(left)
                out["n_words"].append(len(found))
                out["n_removed"].append(len(found) - len(left))
                out["kept_sha256"].append(sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept.decode("utf-8", "surrogatepass"))
            yield out

    hashed = "hash long, doc long, alone long"
    shared = _compared(map_lists(texts, anchors, hashed), smaller_only=False)
    # both joins deal the texts out by k, so they read one exchange
    candidates = map_lists(texts.join(shared, "k").select("doc_id", "k", "text", "hashes"), windows, hashed)
    seen = _compared(candidates, smaller_only=True)
    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return map_lists(texts.join(seen, "k", "left").select("doc_id", "k", "text", "hashes"), removed, columns)
