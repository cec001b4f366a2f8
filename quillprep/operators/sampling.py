"""Exact seeded subsamples and row positions, without a global sort.

Rows are ordered by ``(md5(seed:key), key)``. The hash is uniform, so equal ranges of it hold
about equally many rows: a count per range gives each range's first position, and only rows
inside one range are sorted against each other. No task sees more than one range, however
large a split is, and rows beyond the sample are filtered before anything is shuffled.
Ranges are fine to six standard deviations beyond the wanted size, so the range a sample ends
in is a fine one whatever the seed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.params import SEED
from quillprep.session import cut_lineage

# Rows wanted per hash range, and the most ranges per group.
ROWS_PER_RANGE = 512
MAX_RANGES = 1 << 20

# Rows of a group that a sample in one scan may have, and the parts that it is cut by before the last cut.
SMALL = 10_000
SMALL_PARTS = 64

_HASH_DIGITS = 13  # 52 bits: exact in a double


def order_hash(seed: int | Column, key: Column) -> Column:
    """The hash rows are ordered by: independent of partitioning."""
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed_col, key.cast("string")))


def _by_group(group: str, values: dict, kind: str) -> Column:
    """A literal per group; groups are few and named by the caller."""
    column = F.lit(None).cast(kind)
    for name, value in values.items():
        column = F.when(F.col(group) == F.lit(name), F.lit(value).cast(kind)).otherwise(column)
    return column


def _range_number(group: str, totals: dict, kept: dict) -> Column:
    """A number rising with ``_hash``: fine steps inside the sample, doubling beyond it."""
    scale, fine = {}, {}
    for name, total in totals.items():
        rows = max(float(ROWS_PER_RANGE), kept[name] / MAX_RANGES)
        scale[name] = total / rows
        reach = kept[name] + 6 * math.sqrt(kept[name]) + rows
        fine[name] = max(1, math.ceil(reach / rows))
    digits = F.substring("_hash", 1, _HASH_DIGITS)
    fraction = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**_HASH_DIGITS))
    x = fraction * _by_group(group, scale, "double")
    steps = _by_group(group, fine, "double")
    doubling = steps + F.floor(F.log2(x / steps))
    return F.when(x < steps, F.floor(x)).otherwise(doubling).cast("bigint")


def assign_positions(
    rows: DataFrame,
    sizes: dict,
    group: str = "split",
    key: str = "id",
    seed: int | Column = SEED,
    position: str = "index",
    check_keys: bool = False,
) -> DataFrame:
    """Add each row's position in its group's hash order; keep the first ``sizes[group]``.

    A size of ``None``, or above the group's row count, keeps the whole group. Groups not named
    in ``sizes`` are left out. ``key`` must identify a row of its group: with ``check_keys`` the job
    fails where a kept row's does not. Equal keys share a hash, so they are neighbours by then.

    Counts the groups, then the ranges, when called; both passes read the key columns alone.
    """
    keyed = rows.filter(F.col(group).isin(*sizes))
    # one row per named group
    totals = dict(keyed.groupBy(group).agg(F.count("*")).collect())
    kept = {
        name: total if sizes[name] is None else min(sizes[name], total)
        for name, total in totals.items()
    }
    keyed = keyed.withColumn("_hash", order_hash(seed, F.col(key))).withColumn(
        "_range", _range_number(group, totals, kept)
    )
    counts = cut_lineage(keyed.groupBy(group, "_range").agg(F.count("*").alias("_rows")))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # at most MAX_RANGES and some per group
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    starts = starts.drop("_rows")

    limits = {name: n for name, n in kept.items() if n < totals[name]}
    if limits:
        reached = starts.filter(F.col("_start") < _by_group(group, kept, "bigint"))
        # one row per named group: the last range its sample reaches into
        last = dict(reached.groupBy(group).agg(F.max("_range")).collect())
        keyed = keyed.filter(F.col("_range") <= _by_group(group, last, "bigint"))

    within = Window.partitionBy(group, "_range").orderBy("_hash", key)
    placed = (
        keyed.withColumn("_rank", F.row_number().over(within))
        .withColumn("_before", F.lag(key).over(within) if check_keys else F.lit(None))
        .join(starts, [group, "_range"])
        .withColumn(position, F.col("_start") + F.col("_rank") - 1)
    )
    if check_keys:
        again = F.col("_before").eqNullSafe(F.col(key)) | F.col(key).isNull()
        fault = F.concat(F.lit(f"column {key} does not identify a row: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        checked = F.when(again, F.raise_error(fault).cast("bigint")).otherwise(F.col(position))
        placed = placed.withColumn(position, checked)
    placed = placed.select(*rows.columns, position)
    if limits:
        placed = placed.filter(F.col(position) < _by_group(group, kept, "bigint"))
    return placed


def sample_exact(rows: DataFrame, n: int, key: str = "id", seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, count)`` rows, the same for the same seed, with their position."""
    whole = rows.withColumn("_all", F.lit("all"))
    return assign_positions(whole, {"all": n}, "_all", key, seed).drop("_all")


def sample_per_split(
    rows: DataFrame, sizes: dict, key: str = "id", seed: int = SEED, check_keys: bool = False
) -> DataFrame:
    """One exact sample per split, one seed for all."""
    return assign_positions(rows, sizes, "split", key, seed, check_keys=check_keys)


def sample_small(
    rows: DataFrame, sizes: dict[str, int], group: str = "split", key: str = "id", seed: int | Column = SEED
) -> DataFrame:
    """The same rows as ``sample_per_split``, in one scan, for samples of at most ``SMALL`` rows.

    Each task keeps the rows of the smallest hashes, and what tasks kept is cut again by ``SMALL_PARTS`` before the
    last cut. So as many rows as the sample has leave each task: right where that is little beside what a task reads.
    """
    most = max(sizes.values(), default=0)
    if most > SMALL:
        raise ValueError(f"sample_small takes up to {SMALL} rows of a group, not {most}; use sample_per_split")
    hashed = rows.filter(F.col(group).isin(*sizes)).withColumn("_hash", order_hash(seed, F.col(key)))
    hashed = hashed.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(SMALL_PARTS)))
    for parts in (["_part"], []):
        place = F.row_number().over(Window.partitionBy(group, *parts).orderBy("_hash", key))
        # Spark applies a limit on the number in each task before the shuffle, too
        hashed = hashed.withColumn("_nth", place).filter(F.col("_nth") <= most)
    wanted = F.col("_nth") <= _by_group(group, sizes, "int")
    return hashed.filter(wanted).withColumn("index", (F.col("_nth") - 1).cast("long")).select(*rows.columns, "index")


def index_prefix(rows: DataFrame, n: int, index: str = "index") -> DataFrame:
    """The first ``n`` positions; all rows if there are fewer."""
    return rows.filter(F.col(index) < n)


def duplicate_keys(rows: DataFrame, key: str = "id", group: str = "split") -> DataFrame:
    """Keys that are NULL or occur more than once in their group."""
    return (
        rows.groupBy(group, key)
        .agg(F.count("*").alias("rows"))
        .filter((F.col("rows") > 1) | F.col(key).isNull())
    )


def require_unique_key(rows: DataFrame, key: str = "id", group: str = "split") -> None:
    """Fail if a key does not identify a row."""
    found = duplicate_keys(rows, key, group).head(1)
    if found:
        raise ValueError(
            f"column {key!r} does not identify a row: {found[0].asDict()}; "
            "add one with quillprep.sources.splits.with_row_key"
        )
