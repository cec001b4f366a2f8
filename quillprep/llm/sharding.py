"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves below racks and regions. At each level a child's draw for a key is ``-ln(u) / weight``, with
``u`` from a hash of key, level and child and the weight of all leaves below the child: an exponential arrival time. A key
descends to the region of the smallest draw, there to the rack of the smallest, and there to the shard, so every
subtree takes keys in proportion to its weight, and a key meets one node's children at each level, however many shards
there are.

A child's draw depends on its own weight alone. So when weights below a region change, keys move between
that region and others, or inside it; a key that stays in a subtree without a change keeps its place in it.
Inside a region the same holds for its racks, and in a rack for its shards. A shard that opens a region of its own
therefore only receives keys; one that is added to a rack also moves keys between its region's other shards.

The tree is one constant of the plan, an array of each node's children, so the plan does not grow with it.
Built-in functions only. A null key is a key
of its own, so rows without a key share a shard; a null text has no bytes. Equal rows take
neighbouring slots. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quillprep.llm.columns import bucket_bits, running_total, text_or_empty, unused
from quillprep.session import cut_lineage

ROW_OVERHEAD = 16
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Leaf:
    shard: int
    rack: int
    region: int
    weight: float = 1.0


def layout(
    shards: int, per_rack: int = 5, racks_per_region: int = 2, weights: dict[int, float] | None = None
) -> tuple[Leaf, ...]:
    """Shards 0 to ``shards - 1`` filled into racks and regions in order; one more shard is appended."""
    if min(shards, per_rack, racks_per_region) < 1:
        raise ValueError("shards, per_rack and racks_per_region must be positive")
    weights = weights or {}
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    return tuple(
        Leaf(s, s // per_rack, s // (per_rack * racks_per_region), float(weights.get(s, 1.0))) for s in range(shards)
    )


def with_region(leaves: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """The leaves and one more, in a rack and a region of its own, which takes keys only into itself."""
    after = lambda numbers: max(numbers, default=-1) + 1
    shard, rack, region = (after(getattr(leaf, c) for leaf in leaves) for c in ("shard", "rack", "region"))
    return (*leaves, Leaf(shard, rack, region, weight))


def _arrival(hashed: Column, weight: Column) -> Column:
    """An exponential arrival time; ``u`` has 53 bits and is never 0."""
    u = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(u) / weight


def nodes(leaves: tuple[Leaf, ...]) -> list[list[dict[str, float]]]:
    """Each inner node's children: the root's regions first, then each region's racks, then each rack's shards.

    A child has the ``name`` it is drawn by, the ``weight`` of the leaves below it, and the place ``at`` of its own
    children in the list; a shard has none.
    """
    racks: dict[tuple[int, int], list[Leaf]] = {}
    for leaf in leaves:
        racks.setdefault((leaf.region, leaf.rack), []).append(leaf)
    regions: dict[int, list[int]] = {}
    for region, rack in sorted(racks):
        regions.setdefault(region, []).append(rack)
    place = {key: 1 + len(regions) + k for k, key in enumerate(sorted(racks))}
    below = lambda key: math.fsum(leaf.weight for leaf in racks[key])
    root = [
        {"name": region, "weight": math.fsum(below((region, rack)) for rack in own), "at": 1 + k}
        for k, (region, own) in enumerate(sorted(regions.items()))
    ]
    middle = [
        [{"name": rack, "weight": below((region, rack)), "at": place[region, rack]} for rack in own]
        for region, own in sorted(regions.items())
    ]
    lowest = [[{"name": leaf.shard, "weight": leaf.weight, "at": -1} for leaf in own] for _, own in sorted(racks.items())]
    return [root, *middle, *lowest]


LEVELS = ("region", "rack", "shard")


def descend(rows: DataFrame, leaves: tuple[Leaf, ...], key: list[str], names: tuple[str, str, str] = LEVELS) -> DataFrame:
    """Add the region, the rack and the shard that each row's key descends to, under ``names``."""
    if not leaves:
        raise ValueError("a tree needs a leaf")
    kind = "array<array<struct<name: int, weight: double, at: int>>>"
    tree = F.from_json(F.lit(json.dumps(nodes(leaves))), kind)  # folded into one constant
    keys = [F.col(k) for k in key]

    def first(level: str, at: Column) -> Column:
        def drawn(child: Column) -> Column:
            arrival = _arrival(F.xxhash64(*keys, F.lit(level), child["name"]), child["weight"])
            return F.struct(arrival.alias("draw"), child["name"].alias("name"), child["at"].alias("at"))

        return F.array_min(F.transform(F.get(tree, at), drawn))

    steps = unused(rows, *LEVELS)
    at: Column = F.lit(0)
    for level, step in zip(LEVELS, steps, strict=True):
        rows = rows.withColumn(step, first(level, at))
        at = F.col(step)["at"]
    return rows.withColumns({n: F.col(s)["name"] for n, s in zip(names, steps, strict=True)}).drop(*steps)


def _draw(key: list[Column], leaf: Leaf) -> Column:
    return _arrival(F.xxhash64(*key, F.lit(leaf.shard)), F.lit(leaf.weight))


def _earliest(draws: list[Column]) -> Column:
    return F.least(*draws) if len(draws) > 1 else draws[0]


def place(rows: DataFrame, leaves: tuple[Leaf, ...], key: list[str], name: str = "shard", path: bool = False) -> DataFrame:
    """Add the shard of the smallest draw of all; with ``path``, also its ``region`` and ``rack``.

    Each leaf draws by itself, without a descent, so a changed weight moves keys into or out of its leaf alone, at
    the price of a draw for each leaf and row: for layouts of some dozen leaves. ``descend`` is the tree.
    """
    keys = [F.col(k) for k in key]
    racks: dict[int, list[Column]] = {}
    regions: dict[int, dict[int, Column]] = {}
    for leaf in leaves:
        pair = F.struct(_draw(keys, leaf).alias("draw"), F.lit(leaf.shard).alias("shard"), F.lit(leaf.rack).alias("rack"), F.lit(leaf.region).alias("region"))
        racks.setdefault(leaf.rack, []).append(pair)
    for leaf in leaves:
        regions.setdefault(leaf.region, {})[leaf.rack] = _earliest(racks[leaf.rack])
    best = _earliest([_earliest(list(children.values())) for children in regions.values()])
    out = rows.withColumn("_best", best).withColumn(name, F.col("_best.shard"))
    if path:
        out = out.withColumn("region", F.col("_best.region")).withColumn("rack", F.col("_best.rack"))
    return out.drop("_best")


def slots(rows: DataFrame, count: int, shard: str = "shard", order: tuple[str, ...] = ("doc_id", "text_crc32", "size")) -> DataFrame:
    """Add ``slot``: a row's place in its shard, from 0 without gaps, in order of a hash.

    A shard is numbered in pieces of about ``ROWS_PER_BUCKET`` rows, so no task sorts a whole one.
    ``count`` is the number of rows.
    """
    bits = bucket_bits(count, ROWS_PER_BUCKET)
    (own,) = unused(rows, "slot_hash")
    hashed = rows.withColumn(own, F.xxhash64(*[F.col(c) for c in order], F.lit("slot")))
    bucket = F.shiftright(own, 64 - bits) if bits else F.lit(0)
    by = [F.col(own), *[F.col(c) for c in order]]
    return running_total(hashed, [shard], bucket, by, F.lit(1), "slot").drop(own)


def shard_documents(
    docs: DataFrame,
    leaves: tuple[Leaf, ...],
    grown: tuple[Leaf, ...] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, region, rack, slot`` for each row; ``grown_shard`` if ``grown`` is given."""
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = descend(rows, leaves, ["doc_id"])
    if grown is not None:
        placed = descend(placed, grown, ["doc_id"], ("grown_region", "grown_rack", "grown_shard")).drop("grown_region", "grown_rack")
    placed = cut_lineage(placed)
    return slots(placed, placed.count())


def with_shards(docs: DataFrame, leaves: tuple[Leaf, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``shard, rack, region, slot``; columns of these names are replaced."""
    rows = docs.drop("shard", "rack", "region", "slot")
    return slots(descend(rows, leaves, [id_col]), docs.count(), order=(id_col, text_col))
