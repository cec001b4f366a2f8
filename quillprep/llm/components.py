"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.session import cut_lineage


def _state(links: DataFrame) -> tuple[int, int]:
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    row = links.agg(F.count("*").alias("n"), mixed.alias("h")).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``u, v`` links: root is the smallest node it can reach.

    Each round hangs neighbours on the smallest node around them. Minima combine before the
    shuffle, and the joins have one row per node on one side, so a hub's links are split like
    any skewed join. Rounds grow with the logarithm of the longest chain; each is written to the
    shared folder. Nodes must not be null.
    """
    links = cut_lineage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(links)
    while state[0]:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        links = cut_lineage(small)
        last, state = state, _state(links)
        if state == last:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
