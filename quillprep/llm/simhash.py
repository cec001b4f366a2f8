"""SimHash near-duplicates through vantage-point trees.

A fingerprint has a bit for each of 64 positions, set where over half of the text's shingle hashes
set it. Distinct fingerprints are cut into shards by a tree whose nodes hold a vantage point and a
radius: nearer fingerprints go one way, the others the other. By the triangle inequality, a near
partner of a fingerprint at distance ``d`` lies within ``d - bits`` and ``d + bits`` of the vantage
point, so a fingerprint calls on the other side only where that interval crosses the radius. In each
shard a tree of its own finds exact pairs the same way. Shards give links of a spanning forest, not
pairs, and links are joined to components.

The tree is fitted to a bounded sample; every fingerprint is indexed. At most 2,081 fingerprints
lie within two bits of one, and copies share one, so no shard holds more pairs than that allows;
crowded shards are dealt over a grid of cells.

Defined results: null and empty texts have fingerprint 0, and link like any other. A null id takes
part and gets its component; the component's id is the smallest id that is not null. Repeated rows
stay rows. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillprep.llm.arrow import Lists, map_lists
from quillprep.llm.columns import unused
from quillprep.llm.components import components
from quillprep.session import cut_lineage

SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CHUNK = 1 << 16


@dataclass(frozen=True)
class SimHashParams:
    """``shingle`` in words; fingerprints link at ``bits`` or fewer differing bits.

    The shard tree is fitted to at most ``sample`` fingerprints, of one in ``sample_share``; it has
    about one leaf for ``shard_rows`` fingerprints. A cell holds about ``cell_rows`` on either side.
    """

    shingle: int = 3
    bits: int = 2
    sample: int = 65_536
    sample_share: int = 16
    shard_rows: int = 5_000
    cell_rows: int = 200_000

    def __post_init__(self) -> None:
        if self.shingle < 1 or not 0 <= self.bits < 64:
            raise ValueError("need shingle >= 1 and 0 <= bits < 64")
        if min(self.sample, self.sample_share, self.shard_rows, self.cell_rows) < 1:
            raise ValueError("sample and shard sizes must be positive")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text, unsigned. A text of fewer words is one shingle; one of none has 0."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(found[k:] for k in range(shingle)), strict=False) if len(found) >= shingle else [found]
    hashes = np.array([digest(join(run), SEED) for run in runs], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        octets = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, params: SimHashParams, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest`` of the text and ``fp``, one row per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    width = params.shingle

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        for b in batches:
            yield {"doc_id": b["doc_id"], "digest": b["digest"], "fp": [signed(fingerprint(t, width)) for t in b["text"]]}

    return map_lists(rows, run, f"doc_id {id_type}, digest long, fp long")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """Shards of fingerprints. ``route`` gives each one's own shard and those it must call on."""

    def __init__(self, sample: np.ndarray, leaves: int) -> None:
        self.point, self.radius, self.near, self.far = [], [], [], []
        self.leaves = 0
        self.root = self._grow(sample, leaves)

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        """Nodes are numbers from 0; leaf ``k`` is ``-1 - k``."""
        if leaves > 1 and len(sample) > 1:
            point = sample[0]
            d = distance(sample, point)
            radius = int(np.median(d))
            if radius >= d.max():
                radius = int(d.max()) - 1
            inside = d <= radius
            if inside.any() and not inside.all():
                node = len(self.point)
                self.point.append(point)
                self.radius.append(radius)
                self.near.append(0)
                self.far.append(0)
                self.near[node] = self._grow(sample[inside], leaves // 2)
                self.far[node] = self._grow(sample[~inside], leaves - leaves // 2)
                return node
        self.leaves += 1
        return -self.leaves

    def route(self, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, leaf, own)``. Of two near prints in different shards, one calls on the other's."""
        rows, shards, own = [], [], []
        todo = [(self.root, np.arange(len(prints)), np.zeros(0, np.int64))]
        while todo:
            node, home, guest = todo.pop()
            if node < 0:
                rows += [home, guest]
                shards.append(np.full(len(home) + len(guest), -1 - node))
                own += [np.ones(len(home), bool), np.zeros(len(guest), bool)]
                continue
            d = distance(prints[home], self.point[node]).astype(np.int64)
            e = distance(prints[guest], self.point[node]).astype(np.int64)
            inside, radius = d <= self.radius[node], self.radius[node]
            near_guests = guest[e <= radius + bits]
            far_guests = np.concatenate([guest[e > radius - bits], home[inside & (d > radius - bits)]])
            if inside.any() or len(near_guests):
                todo.append((self.near[node], home[inside], near_guests))
            if not inside.all() or len(far_guests):
                todo.append((self.far[node], home[~inside], far_guests))
        return np.concatenate(rows), np.concatenate(shards), np.concatenate(own)


def near_pairs(index: np.ndarray, queries: np.ndarray, bits: int, brute: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``(in queries, in index)`` of all pairs within ``bits``, in blocks."""
    todo = [(np.arange(len(index)), np.arange(len(queries)))]
    while todo:
        i, q = todo.pop()
        if not len(i) or not len(q):
            continue
        if len(i) * len(q) > brute and len(i) > 1:
            point = index[i[len(i) // 2]]
            d, e = distance(index[i], point).astype(np.int64), distance(queries[q], point).astype(np.int64)
            radius = min(int(np.median(d)), int(d.max()) - 1)
            inside = d <= radius
            if inside.any():
                todo += [(i[inside], q[e <= radius + bits]), (i[~inside], q[e > radius - bits])]
                continue
        step = max(1, brute // len(i))
        for at in range(0, len(q), step):
            part = q[at : at + step]
            a, b = np.nonzero(distance(queries[part][:, None], index[i][None, :]) <= bits)
            yield part[a], i[b]


def forest(index: np.ndarray, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(print, smallest print of its component)`` that join whatever is near in one cell."""
    nodes, place = np.unique(np.concatenate([index, queries]), return_inverse=True)
    label = np.arange(len(nodes))
    for q, i in near_pairs(index, queries, bits):
        a, b = place[len(index) + q], place[i]
        while True:
            low = np.minimum(label[a], label[b])
            if (low == label[a]).all() and (low == label[b]).all():
                break
            for side in (a, b):
                np.minimum.at(label, label[side], low)
            while not np.array_equal(label, jumped := label[label]):
                label = jumped
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def links(prints: DataFrame, params: SimHashParams) -> DataFrame:
    """``u, v`` links between the distinct fingerprints of ``prints`` that span all near pairs."""
    spark = prints.sparkSession
    bits = params.bits
    count = prints.count()
    order = F.xxhash64("fp", F.lit("sample"))
    sampled = prints.select("fp", order.alias("h")).filter(F.pmod("h", F.lit(params.sample_share)) == 0)
    sample = [r.fp for r in sampled.orderBy("h").limit(params.sample).collect()]
    tree = VantageTree(np.array(sample, np.int64).view(np.uint64), -(-count // params.shard_rows))
    shared = spark.sparkContext.broadcast(tree)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64)
            row, shard, home = shared.value.route(own.view(np.uint64), bits)
            yield pd.DataFrame({"shard": shard, "fp": own[row], "home": home})

    routed = cut_lineage(prints.select("fp").mapInPandas(route, "shard long, fp long, home boolean"))
    sizes = routed.groupBy("shard").agg(F.count("*").alias("all"), F.count_if("home").alias("homes")).collect()
    grid = spark.createDataFrame(
        [(r.shard, max(1, -(-r["all"] // params.cell_rows)), max(1, -(-r.homes // params.cell_rows))) for r in sizes],
        "shard long, down int, across int",
    )  # a row per leaf: no more than the sample has
    dealt = routed.join(F.broadcast(grid), "shard")
    part = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asks = dealt.select("shard", part("down").alias("row"), every("across").alias("col"), "fp", F.lit(True).alias("asks"))
    held = dealt.filter("home").select("shard", every("down").alias("row"), part("across").alias("col"), "fp", F.lit(False).alias("asks"))

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        own, asking = cell["fp"].to_numpy(np.int64).view(np.uint64), cell["asks"].to_numpy(bool)
        u, v = forest(own[~asking], own[asking], bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return asks.unionAll(held).groupBy("shard", "row", "col").applyInPandas(search, "u long, v long")


def near_duplicates(
    docs: DataFrame, params: SimHashParams = SimHashParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, digest, fp, component_id`` and ``first``: whether the row's id, or for ties its text, is the component's first."""
    rows = cut_lineage(fingerprints(docs, params, id_col, text_col))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    prints = cut_lineage(rows.groupBy("fp").agg(F.min(rank).alias("lead")))
    found = components(links(prints, params)).withColumnRenamed("node", "fp")
    members = cut_lineage(prints.join(found, "fp"))
    leads = members.groupBy("root").agg(F.min("lead").alias("joint"))
    joint = members.select("fp", "root").join(leads, "root").select("fp", "joint")
    named = prints.join(joint, "fp", "left").select("fp", F.coalesce("joint", "lead").alias("lead"))
    return rows.join(named, "fp").select(
        "doc_id",
        "digest",
        "fp",
        F.col("lead.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("digest") == F.col("lead.digest"))).alias("first"),
    )


def one_of_each(docs: DataFrame, params: SimHashParams = SimHashParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the smallest id's, of repeated rows any one."""
    firsts = near_duplicates(docs, params, id_col, text_col).filter("first")
    names = unused(docs, "id", "none", "digest")
    key = lambda c, d: [F.coalesce(c.cast("string"), F.lit("")).alias(names[0]), c.isNull().alias(names[1]), d.alias(names[2])]
    kept = firsts.select(*key(F.col("doc_id"), F.col("digest"))).distinct()
    tagged = docs.select("*", *key(F.col(id_col), F.xxhash64(text_col)))
    # combines before the shuffle, so a row that is repeated often meets itself in pieces
    return tagged.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)
