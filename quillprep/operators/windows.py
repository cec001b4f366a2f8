"""Several examples in one window: first-fit decreasing by a histogram of lengths, without a global sort.

First-fit decreasing looks at lengths alone, and equal ones fill windows in turn. So windows are planned from the number
of examples of each length: the plan says which ranks of a length go to which windows. An example finds its window
by its rank among those of its length, counted in ranges of a hash. Only the last step, which joins the examples of
a window, moves their ids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.functions.arrays import resolve_pad
from quillprep.operators.sampling import ROWS_PER_RANGE, order_hash
from quillprep.params import IGNORE_LABEL, PrepParams
from quillprep.session import cut_lineage

# Lengths are planned in so many steps of a window at most, rounded up.
LENGTH_STEPS = 2_048


@dataclass(frozen=True)
class Stretch:
    """Ranks ``start`` and on of a length, ``each`` to a window, from window ``first`` on."""

    length: int
    start: int
    first: int
    each: int


def plan_windows(counts: dict[int, int], budget: int) -> tuple[list[Stretch], int]:
    """First-fit decreasing over ``counts`` examples of each length: stretches, and the number of windows.

    Windows with equal room that lie side by side are one run, so the work depends on the number of lengths alone.
    """
    if counts and not 1 <= min(counts) <= max(counts) <= budget:
        raise ValueError(f"lengths must lie between 1 and the window's {budget}")
    runs: list[tuple[int, int, int]] = []  # first window, windows, room left in each
    plan: list[Stretch] = []
    windows = 0
    for length in sorted(counts, reverse=True):
        left, rank, after = counts[length], 0, []
        most = budget // length
        # runs with room, then as many new windows as the rest can need
        for first, many, room in [*runs, (windows, -(-left // most), budget)]:
            fit, opened = room // length, first == windows
            used = 0
            while left and fit and used < many:
                each = min(fit, left)
                full = min(many - used, left // each)
                plan.append(Stretch(length, rank, first + used, each))
                after.append((first + used, full, room - each * length))
                left, rank, used = left - full * each, rank + full * each, used + full
            if opened:
                windows += used
            elif used < many:
                after.append((first + used, many - used, room))
        runs = [r for r in after if r[2] > 0]
    return plan, windows


def with_ranks(rows: DataFrame, group: str, key: str, seed: int | str, total: int) -> DataFrame:
    """Add ``rank``: a row's place among the rows of its group, in order of a hash; ``total`` counts all rows.

    Rows are sorted inside a range of the hash, so a group of any size is spread. ``key`` must identify a row.
    """
    bits = max(0, -(-total // ROWS_PER_RANGE) - 1).bit_length()
    hashed, span, count, start, nth = (f"_rank_{n}" for n in ("hash", "range", "count", "start", "nth"))
    digits = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long")
    cut = rows.withColumn(hashed, order_hash(seed, F.col(key))).withColumn(span, F.shiftright(digits, 32 - bits))
    before = Window.partitionBy(group).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    counted = cut.groupBy(group, span).agg(F.count("*").alias(count))
    starts = counted.select(group, span, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(start))
    within = Window.partitionBy(group, span).orderBy(hashed, key)
    ranked = cut.withColumn(nth, F.row_number().over(within) - 1).join(starts, [group, span])
    return ranked.withColumn("rank", F.col(start) + F.col(nth)).select(*rows.columns, "rank")


def assign_windows(lengths: DataFrame, budget: int, key: str = "id", seed: int | str = 0) -> DataFrame:
    """``key, length`` rows with their ``window`` and ``place``, which orders the examples of a window."""
    unit = max(1, budget // LENGTH_STEPS)
    sized = lengths.withColumn("_step", F.ceil(F.greatest(F.col("length"), F.lit(1)) / unit).cast("int"))
    # a row for each step at most
    counts = {r["_step"]: r.n for r in sized.groupBy("_step").agg(F.count("*").alias("n")).collect()}
    plan, _ = plan_windows(counts, budget // unit)
    stretches: dict[int, list[tuple[int, int, int]]] = {}
    for s in plan:
        stretches.setdefault(s.length, []).append((s.start, s.first, s.each))
    schema = "_step int, _stretches array<struct<start: long, first: long, each: long>>"
    table = F.broadcast(lengths.sparkSession.createDataFrame(list(stretches.items()), schema))
    ranked = with_ranks(sized, "_step", key, seed, sum(counts.values())).join(table, "_step")
    own = F.element_at(F.filter("_stretches", lambda s: s["start"] <= F.col("rank")), -1)
    found = ranked.withColumn("_own", own)
    window = F.col("_own.first") + F.floor((F.col("rank") - F.col("_own.start")) / F.col("_own.each"))
    place = F.struct((-F.col("_step")).alias("longest"), F.col("rank").alias("rank"))
    return found.select(*lengths.columns, window.cast("long").alias("window"), place.alias("place"))


def packed_windows(examples: DataFrame, params: PrepParams, key: str = "id") -> DataFrame:
    """``prompt_ids, target_ids`` to windows of ``max_len``: each example in one, none cut.

    ``window, keys, input_ids, labels, segment_ids, positions``: segments are numbered from 1, 0 is padding, and
    positions start anew in each, so that a trainer can keep examples apart. Labels cover targets alone.
    """
    examples = cut_lineage(examples.select(key, "prompt_ids", "target_ids"))
    lengths = examples.select(key, (F.size("prompt_ids") + F.size("target_ids")).alias("length"))
    assigned = assign_windows(lengths, params.max_len, key, params.seed).drop("length")
    grouped = examples.join(assigned, key).groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct("place", key, "prompt_ids", "target_ids"))).alias("parts")
    )
    pad = F.lit(resolve_pad(params.pad_id, params.eos_id))
    size = lambda e: F.size(e["prompt_ids"]) + F.size(e["target_ids"])

    def laid(one: Callable[..., Column], padding: Column) -> Column:
        """An array for each example, one after another, padded on the right."""
        joined = F.flatten(F.transform("parts", one))
        return F.concat(joined, F.array_repeat(padding, F.lit(params.max_len) - F.size(joined)))

    return grouped.select(
        "window",
        F.transform("parts", lambda e: e[key]).alias("keys"),
        laid(lambda e: F.concat(e["prompt_ids"], e["target_ids"]), pad).alias("input_ids"),
        laid(lambda e: F.concat(F.array_repeat(F.lit(IGNORE_LABEL), F.size(e["prompt_ids"])), e["target_ids"]), F.lit(IGNORE_LABEL)).alias("labels"),
        laid(lambda e, n: F.array_repeat(n + 1, size(e)), F.lit(0)).alias("segment_ids"),
        laid(lambda e: F.when(size(e) > 0, F.sequence(F.lit(0), size(e) - 1)).otherwise(F.array().cast("array<int>")), F.lit(0)).alias("positions"),
    )
