"""A Merkle manifest of rows, and proofs folded through retained hash states.

Rows are leaves in order within scopes. While a level of a scope has several nodes, every ``children`` consecutive
ones, or the fewer left over at its end, become one parent: the SHA-256 of their digests as hex text. What remains is the
scope's subroot; subroots in order of their scopes give the root the same way.

A parent keeps a copy of its hash state from before each child's slot. A replaced child is folded in by resuming the
state of its slot and adding the replacement and the siblings to its right; those to its left are in the state already.

Trees are cut into tiles of ``levels`` levels, each built by one task from its lowest digests: a tier of tiles gives the
lowest digests of the next. The manifest is the table of those digests, tier by tier, a few rows more than leaves. Folding
climbs the tiers: a tile's digests meet the values that rise through it, in pieces of at most ``rows_per_piece`` values, so
that neither a large scope nor the tiles at the top, which every value passes, come to one task.

Defined results: a null field is written as ``-``, so it differs from an empty text. Null scopes come first, and so do
null ids; rows of equal id follow each other in order of their leaves, and repeated rows keep places of their own. An
empty table gives an empty result. Columns that are not named as fields are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.llm.columns import running_total
from quillprep.llm.ordering import in_pieces, numbered
from quillprep.session import cut_lineage


@dataclass(frozen=True)
class MerkleParams:
    """``children`` of a node, ``levels`` of a tile; bounds on the rows that one task takes at once."""

    children: int = 2
    levels: int = 12
    rows_per_piece: int = 16_384

    def __post_init__(self) -> None:
        if self.children < 2 or self.levels < 1 or self.rows_per_piece < 1:
            raise ValueError("need children >= 2, levels >= 1, rows_per_piece >= 1")

    @property
    def width(self) -> int:
        """Lowest digests of a tile."""
        return self.children**self.levels


def field(column: Column) -> Column:
    """A field as the leaf's hash takes it: bytes of its text, a colon and the text, or ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    """SHA-256 of the fields, as bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


class Parent:
    """A node over its children's hex digests, with a copy of the hash state from before each of them."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: list[bytes]) -> None:
        self.children, self.states = children, []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def replaced(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in a slot: from that slot's state, with the siblings to its right."""
        state = self.states[slot].copy()
        state.update(child)
        for sibling in self.children[slot + 1 :]:
            state.update(sibling)
        return state.hexdigest().encode()


class Tile:
    """A subtree over its lowest digests; ``levels`` of None goes on until one node remains."""

    def __init__(self, digests: list[bytes], children: int, levels: int | None) -> None:
        self.children, self.levels = children, []
        while len(digests) > 1 if levels is None else len(self.levels) < levels:
            parents = [Parent(digests[at : at + children]) for at in range(0, len(digests), children)]
            self.levels.append(parents)
            digests = [p.digest for p in parents]
        self.top = digests[0]

    def fold(self, slot: int, value: bytes) -> tuple[bytes, bytes]:
        """The top with another digest in a lowest slot, and the siblings on the way, from left to right."""
        siblings = []
        for parents in self.levels:
            parent, nth = parents[slot // self.children], slot % self.children
            siblings += parent.children[:nth] + parent.children[nth + 1 :]
            value, slot = parent.replaced(nth, value), slot // self.children
        return value, b"".join(siblings)


def _tile(digests: pa.Table, params: MerkleParams) -> Tile:
    ordered = digests.sort_by("rank")
    alone = ordered["n"][0].as_py() <= params.width
    lowest = [d.hex().encode() for d in ordered["digest"].to_pylist()]
    return Tile(lowest, params.children, None if alone else params.levels)


def _tiled(nodes: DataFrame, params: MerkleParams) -> DataFrame:
    return nodes.withColumn("tile", F.expr(f"rank div {params.width}"))


def build(leaves: DataFrame, params: MerkleParams = MerkleParams()) -> list[DataFrame]:
    """The tiers of ``scope, rank, n, digest``: ``leaves`` first, with ``n`` of them in a scope, subroots last."""

    def top(digests: pa.Table) -> pa.Table:
        made = {"scope": digests["scope"][:1], "rank": digests["tile"][:1], "n": [-(-digests["n"][0].as_py() // params.width)]}
        return pa.table(made | {"digest": [bytes.fromhex(_tile(digests, params).top.decode())]})

    tiers = [leaves.select("scope", "rank", "n", "digest")]
    most = leaves.agg(F.max("n")).head()[0] or 0
    while True:
        schema = "scope long, rank long, n long, digest binary"
        tiers.append(cut_lineage(_tiled(tiers[-1], params).groupBy("scope", "tile").applyInArrow(top, schema)))
        most = -(-most // params.width)
        if most <= 1:
            return tiers


def fold(tiers: list[DataFrame], values: DataFrame, params: MerkleParams = MerkleParams(), once: bool = True) -> DataFrame:
    """Raise ``row_no, scope, rank, n, value, proof`` and whatever columns come with them to the top.

    ``value`` stands in place of the leaf at ``rank``, and ``proof`` gets the siblings' digests on the way, as hex text.
    ``n`` is the number of values of a scope. With ``once`` a leaf has one at most, so a tile is passed by no more than
    it has leaves below.
    """

    def climb(digests: pa.Table, rising: pa.Table) -> pa.Table:
        tile = _tile(digests, params) if rising.num_rows else None
        columns = (rising[c].to_pylist() for c in ("rank", "value", "proof"))
        passed = [(tile.fold(r % params.width, v.hex().encode()), p) for r, v, p in zip(*columns, strict=True)]
        made = {
            "rank": pa.array([r // params.width for r in rising["rank"].to_pylist()], pa.int64()),
            "value": pa.array([bytes.fromhex(v.decode()) for (v, _), _ in passed], pa.binary()),
            "proof": pa.array([p + own for (_, own), p in passed], pa.binary()),
        }
        return pa.table({c: made.get(c, rising[c]) for c in names})

    names, schema = values.columns, values.schema
    by = ["scope", "tile", "piece"]
    for k, tier in enumerate(tiers[:-1]):
        most = F.least(F.col("n"), F.lit(min(params.width ** (k + 1), 1 << 62))) if once else F.col("n")
        pieces = F.ceil(most / params.rows_per_piece)
        sizes = values.groupBy("scope").agg(F.max(pieces).alias("pieces"))
        lowest = _tiled(tier, params).join(sizes, "scope").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
        rising = _tiled(values, params).withColumn("piece", F.pmod(F.xxhash64("row_no"), pieces))
        # columns of their own, as both sides may stem from the same leaves
        lowest = lowest.select(*[F.col(c).alias(c) for c in (*by, "rank", "n", "digest")])
        values = cut_lineage(lowest.groupBy(*by).cogroup(rising.groupBy(*by)).applyInArrow(climb, schema))
    return values


@dataclass(frozen=True)
class Manifest:
    """Placed ``leaves``, the tiers of the scopes' trees, and those of the tree over the subroots, whose last has the root."""

    leaves: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]


def manifest(docs: DataFrame, digest: Column, scope_col: str, id_col: str, keep: dict[str, Column], params: MerkleParams = MerkleParams()) -> Manifest:
    """Leaves in order of their ids within scopes, and the trees over them. ``keep`` names columns that leaves carry along.

    Scopes are numbered in one task, a row for each.
    """
    rows = numbered(docs.select(F.col(scope_col).alias("name"), F.col(id_col).alias("id"), digest.alias("digest"), *[c.alias(k) for k, c in keep.items()]))
    by_name = Window.orderBy(F.col("name").asc_nulls_first())
    scopes = cut_lineage(
        rows.groupBy("name").agg(F.count("*").alias("n")).withColumn("scope", (F.row_number().over(by_name) - 1).cast("long"))
    )
    size = scopes.agg(F.count("*").alias("scopes"), F.coalesce(F.sum("n"), F.lit(0)).alias("leaves")).head()
    named = scopes.withColumnRenamed("name", "of")
    placed = rows.join(named, F.col("name").eqNullSafe(F.col("of"))).drop("name", "of")
    order = [F.col("scope"), F.col("id").asc_nulls_first(), F.col("digest")]
    ranged = cut_lineage(in_pieces(placed, order, -(-size.leaves // params.rows_per_piece), "place"))
    leaves = cut_lineage(running_total(ranged, ["scope"], F.col("place"), [*order, F.col("row_no")], F.lit(1), "rank"))
    tiers = build(leaves, params)
    zero, count = F.lit(0).cast("long").alias("scope"), F.lit(size.scopes).cast("long").alias("n")
    subroots = tiers[-1].select(zero, F.col("scope").alias("rank"), count, "digest")
    return Manifest(leaves, tiers, build(subroots, params))


def folded(made: Manifest, value: str, params: MerkleParams = MerkleParams()) -> DataFrame:
    """Each leaf with ``subroot, root``, the ``folded_root`` with its column ``value`` in its place, and its ``proof``."""
    root = made.top[-1].head()
    subroots = made.tiers[-1].select("scope", F.col("digest").alias("subroot"))
    values = made.leaves.withColumnRenamed(value, "value").withColumn("proof", F.expr("X''"))
    raised = fold(made.tiers, values, params).drop("rank").join(subroots, "scope")
    raised = raised.withColumnRenamed("scope", "rank").withColumns(
        {"scope": F.lit(0).cast("long"), "n": F.lit(made.leaves.count()).cast("long")}
    )
    high = fold(made.top, raised, params, once=False)
    return high.withColumnRenamed("value", "folded_root").withColumn("root", F.lit(root.digest if root else None).cast("binary")).drop("scope", "rank", "n")
