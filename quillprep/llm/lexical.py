"""Ranked lexical search: the best documents for each query, by a hybrid of term and document order.

An index cuts the documents into shards of bounded size. A shard holds, for every term that any query has, the places
of the documents that hold it, in order, and how often. Shards are made where the documents lie and carry
what the collection's statistics need, so weights are sums over shards.

Each shard is searched for each query. Short posting lists are taken a term at a time: their contributions are added up
in accumulators. The accumulators, in order of documents, are then one more list, whose greatest sum bounds it, and
documents are met in ascending order over it and the long lists. The lists of least bounds that could not, even
together, lift a document over the fiftieth best so far are not walked: their documents are met only where a walked list
has them, by skipping to the place, and not at all once what a document has and may still get is too little.
Documents are met a run at a time, so that a step is an array operation.

All scores are whole numbers, and documents of equal score rank by id, so the result does not depend on shards.

Queries are taken in blocks of about ``block_terms`` terms, each query's counted once; each block's result is written before the next is
read. What is broadcast, a block's terms, weights and queries, is bounded by that.

Defined results: null and empty texts have no term, count for no statistic and never rank. A null id ranks after all
others of its score. Documents of equal id and score are told apart by no order but have ranks of their own. Repeated
queries are one query each, with their own ranks. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from quillprep.llm.columns import running_total
from quillprep.llm.ordering import numbered
from quillprep.session import cut_lineage, scratch_path

# A term is a run of ASCII letters and digits and of all that is not ASCII; only ASCII letters are folded.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class SearchParams:
    """``top`` documents for each query. A shard has about ``shard_postings`` postings and at most ``shard_docs`` documents.

    Lists of at most ``short`` postings are accumulated first; ``run`` documents are met in a step.
    """

    top: int = 50
    short: int = 256
    run: int = 512
    shard_docs: int = 16_384
    shard_postings: int = 1 << 20
    block_terms: int = 200_000

    def __post_init__(self) -> None:
        if min(self.top, self.run, self.shard_docs, self.shard_postings, self.block_terms) < 1 or self.short < 0:
            raise ValueError("sizes must be positive")


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(holding: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding.astype(np.float64) + 1))).astype(np.int64)


def contributions(weights: np.ndarray | int, tf: np.ndarray, length: np.ndarray, documents: int, words: int) -> np.ndarray:
    """What terms of these weights, ``tf`` times in documents of this ``length``, add to their scores."""
    m = 50 + 50 * length * documents // max(words, 1)
    return weights * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Postings:
    """A shard being made: terms' documents and counts."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[int] = []
        self.docs: list[int] = []
        self.tf: list[int] = []

    def add(self, doc_id: int | None, length: int, found: dict[int, int]) -> None:
        self.docs += [len(self.doc_ids)] * len(found)
        self.terms += found.keys()
        self.tf += found.values()
        self.doc_ids.append(doc_id)
        self.lengths.append(length)

    def row(self, names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
        """Documents in order of their ids, nulls last; lists in order of terms, documents ascending."""
        ids = pa.array(self.doc_ids, id_type)
        by_id = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(by_id), np.int32)
        place[by_id] = np.arange(len(by_id), dtype=np.int32)
        docs, owner = place[np.array(self.docs, np.int64)], np.array(self.terms, np.int32)
        order = np.lexsort((docs, owner))
        distinct, counts = np.unique(owner, return_counts=True)
        values = [
            ids.take(pa.array(by_id)),
            np.array(self.lengths, np.int64)[by_id],
            distinct.astype(np.int32),
            counts.astype(np.int32),
            docs[order],
            np.array(self.tf, np.int32)[order],
        ]
        arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in values]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in arrays]
        return pa.RecordBatch.from_arrays(lists, names)


SHARD = ["doc_ids", "lengths", "terms", "counts", "docs", "tf"]


def index(docs: DataFrame, known: dict[bytes, int], params: SearchParams, id_col: str, text_col: str) -> DataFrame:
    """A row for each shard, of the lists in ``SHARD``. Documents without any known term are counted, not listed.

    ``lengths`` has the terms of listed documents; ``unlisted`` and ``unlisted_terms`` are the number of others that hold
    some term, and their terms.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type, spark = rows.schema["doc_id"].dataType.simpleString(), docs.sparkSession
    shared = spark.sparkContext.broadcast(known)
    names = [*SHARD, "unlisted", "unlisted_terms"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        held, others, other_terms, kind = Postings(), 0, 0, pa.int64()

        def close() -> pa.RecordBatch:
            made = held.row(SHARD, kind)
            more = [pa.array([n], pa.int64()) for n in (others, other_terms)]
            return pa.RecordBatch.from_arrays([*made.columns, *more], names)

        for b in batches:
            kind = b.column("doc_id").type
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                words = terms(text.as_py())
                found: dict[int, int] = {}
                for w in words:
                    k = number(w)
                    if k is not None:
                        found[k] = found.get(k, 0) + 1
                if found:
                    held.add(doc_id, len(words), found)
                elif words:
                    others, other_terms = others + 1, other_terms + len(words)
                if len(held.doc_ids) >= params.shard_docs or len(held.docs) >= params.shard_postings:
                    yield close()
                    held, others, other_terms = Postings(), 0, 0
        if held.doc_ids or others:
            yield close()

    schema = f"doc_ids array<{id_type}>, lengths array<long>, terms array<int>, counts array<int>, docs array<int>, tf array<int>, unlisted long, unlisted_terms long"
    return rows.mapInArrow(run, schema)


class Shard:
    """A shard as it is searched: documents' ids and each term's list of documents and what it adds to their scores."""

    def __init__(self, row: dict[str, np.ndarray], weights: np.ndarray, documents: int, words: int) -> None:
        self.size = len(row["lengths"])
        owner = np.repeat(row["terms"], row["counts"])
        self.docs = row["docs"].astype(np.int64)
        self.adds = contributions(weights[owner], row["tf"].astype(np.int64), row["lengths"][self.docs], documents, words)
        edges = np.concatenate([[0], np.cumsum(row["counts"])])
        self.range = {t: (a, b) for t, a, b in zip(row["terms"].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)}
        self.most = dict(zip(row["terms"].tolist(), np.maximum.reduceat(self.adds, edges[:-1]).tolist(), strict=True)) if len(self.docs) else {}

    def lists(self, query: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """``(bound, documents, additions)`` of the query's terms that the shard has."""
        found = [(self.most[t], *self.range[t]) for t in query if t in self.range]
        return [(most, self.docs[a:b], self.adds[a:b]) for most, a, b in found if most > 0]


def accumulated(short: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Short lists, a term at a time, as one list of sums with its bound."""
    docs, place = np.unique(np.concatenate([d for _, d, _ in short]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    end = 0
    for _, d, adds in short:
        sums[place[end : end + len(d)]] += adds
        end += len(d)
    return int(sums.max()), docs, sums


def _best(docs: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` best, highest first, of equal ones the earlier document."""
    order = np.lexsort((docs, -scores))[:top]
    return docs[order], scores[order]


def search(lists: list[tuple[int, np.ndarray, np.ndarray]], params: SearchParams, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The best documents of a shard for a query's lists, and their scores; only such as score over ``floor``.

    Documents are met in ascending order, so a later one of the last best's score stays behind it.
    """
    walk = [x for x in lists if len(x[1]) > params.short]
    if short := [x for x in lists if len(x[1]) <= params.short]:
        walk.append(accumulated(short))
        sums = walk[-1][2]
        if len(sums) >= params.top:  # so many documents have these sums or more; one that ties may come first
            floor = max(floor, int(np.partition(sums, -params.top)[-params.top]) - 1)
    walk.sort(key=lambda x: x[0])
    together = np.cumsum([most for most, _, _ in walk])  # no document gets more from a list and those before it
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = [0] * len(walk)
    while True:
        first = int(np.searchsorted(together, floor, "right"))  # lists before it need not be walked
        ahead = {k: walk[k][1][at[k] : at[k] + params.run] for k in range(first, len(walk))}
        ahead = {k: d for k, d in ahead.items() if len(d)}
        if not ahead:
            return docs, scores
        upto = min(int(d[-1]) for d in ahead.values())
        met = np.unique(np.concatenate([d[: np.searchsorted(d, upto, "right")] for d in ahead.values()]))
        score = np.zeros(len(met), np.int64)
        for k, d in ahead.items():
            n = int(np.searchsorted(d, upto, "right"))
            score[np.searchsorted(met, d[:n])] += walk[k][2][at[k] : at[k] + n]
            at[k] += n
        for k in range(first - 1, -1, -1):
            hopeful = score + together[k] > floor
            met, score = met[hopeful], score[hopeful]
            if not len(met):
                break
            _, there, adds = walk[k]
            place = np.minimum(np.searchsorted(there, met), len(there) - 1)
            score += np.where(there[place] == met, adds[place], 0)
        over = score > floor
        if over.any():
            docs, scores = _best(np.concatenate([docs, met[over]]), np.concatenate([scores, score[over]]), params.top)
            if len(docs) == params.top:
                floor = max(floor, int(scores[-1]))


class Best:
    """The best documents of a query over the shards seen."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def floor(self) -> int:
        """Documents of other shards need more than this; one that ties may have the smaller id."""
        return -self.rows[-1][0] - 1 if len(self.rows) == self.top else 0

    def add(self, scores: list[int], ids: list) -> None:
        self.rows += [(-s, d is None, 0 if d is None else d) for s, d in zip(scores, ids, strict=True)]
        self.rows.sort()
        del self.rows[self.top :]


def _queries(items: DataFrame, params: SearchParams, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``row_no, item_id, terms`` of each query, with the ``block`` it is in, and the number of blocks."""
    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([sorted(set(terms(t))) for t in b.column("text").to_pylist()], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column("item_id"), found], ["item_id", "terms"])

    kind = rows.schema["item_id"].dataType.simpleString()
    split = numbered(rows.mapInArrow(distinct, f"item_id {kind}, terms array<binary>").filter(F.size("terms") > 0))
    laid = running_total(split, [], F.shiftright("row_no", 33), [F.col("row_no")], F.size("terms"), "before")
    blocked = cut_lineage(laid.withColumn("block", F.expr(f"before div {params.block_terms}")).drop("before"))
    return blocked, (blocked.agg(F.max("block")).head()[0] or 0) + 1


def ranked(
    docs: DataFrame,
    items: DataFrame,
    params: SearchParams = SearchParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each query that score above 0, best first."""
    spark = docs.sparkSession
    queries, blocks = _queries(items, params, item_col, item_text_col)
    path = scratch_path(spark, "ranked")
    for block in range(blocks):
        mine = queries.filter(F.col("block") == block).select("row_no", "item_id", "terms")
        _search_block(docs, mine, params, id_col, text_col).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _search_block(docs: DataFrame, mine: DataFrame, params: SearchParams, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    given = [(r.row_no, [bytes(t) for t in r.terms]) for r in mine.select("row_no", "terms").toLocalIterator()]
    known: dict[bytes, int] = {}
    asked = [(row, [known.setdefault(t, len(known)) for t in found]) for row, found in given]
    shards = cut_lineage(index(docs, known, params, id_col, text_col))
    size = shards.agg(
        F.coalesce(F.sum(F.size("doc_ids") + F.col("unlisted")), F.lit(0)).alias("documents"),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x) + F.col("unlisted_terms")), F.lit(0)).alias("words"),
    ).head()
    # a row for each of the block's terms at most
    pairs = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("e")).groupBy("e.terms").agg(F.sum("e.counts").alias("n")).toArrow()
    holding = np.zeros(len(known), np.int64)
    holding[pairs["terms"].to_numpy()] = pairs["n"].to_numpy()
    shared = spark.sparkContext.broadcast((asked, weight(holding, size.documents)))
    documents, words = size.documents, size.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best, kind = [Best(params.top) for _ in asked], None
        for b in batches:
            kind = b.schema.field("doc_ids").type.value_type
            for k in range(b.num_rows):
                row = {c: b.column(c)[k].values for c in SHARD}
                ids = row.pop("doc_ids")
                shard = Shard({c: v.to_numpy() for c, v in row.items()}, weights, documents, words)
                for own, (_, query) in zip(best, asked, strict=True):
                    found, scores = search(shard.lists(query), params, own.floor)
                    if len(found):
                        own.add(scores.tolist(), ids.take(pa.array(found)).to_pylist())
        if kind is None:
            return
        rows = [(n, None if none else d, -s) for own, (n, _) in zip(best, asked, strict=True) for s, none, d in own.rows]
        columns = [[r[c] for r in rows] for c in range(3)]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), kind, pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["row_no", "doc_id", "score"])

    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()
    found = shards.select(*SHARD).mapInArrow(run, f"row_no long, doc_id {id_type}, score long")
    # the limit on the rank is applied in each task before the shuffle as well
    by_score = Window.partitionBy("row_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    kept = found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= params.top)
    return kept.join(mine.select("row_no", "item_id"), "row_no").select("item_id", "rank", "doc_id", "score")
