"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents are laid out in hash order on an axis of words and cut into blocks of equal
length. Slot ``i`` of the mix is the point ``i * golden ratio mod 1``; the cumulative target shares
map it to a source, and the slot's rank among its source's slots names the block. So each stretch
of the mix has the sources in their shares, and each source is read evenly.

Built-in functions only. Sources are ranked in one task, with one row per source; nothing else is
gathered. Nulls: a null text has size 0, a null source is a source of its own, null and repeated ids
are rows like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.llm.columns import bucket_bits, running_total, text_or_empty, unused, word_count
from quillprep.session import cut_lineage

# 2^30 points and the odd number nearest to their golden section.
LATTICE = 1 << 30
GOLDEN = 663_608_941


@dataclass(frozen=True)
class MixParams:
    """``weights`` repeat over the sources in code point order, null last.

    A source gives at most ``max_epochs`` times its words. A block has ``block_words`` words, or
    fewer where the mix would have under ``min_slots`` slots.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    max_epochs: int = 3
    block_words: int = 4096
    min_slots: int = 65_536
    rows_per_bucket: int = 20_000
    slots_per_bucket: int = 8_192

    def __post_init__(self) -> None:
        if not self.weights or min(self.weights) < 1 or self.max_epochs < 1:
            raise ValueError("weights and max_epochs must be positive")
        if min(self.block_words, self.min_slots, self.rows_per_bucket, self.slots_per_bucket) < 1:
            raise ValueError("block and bucket sizes must be positive")


def digest(id_col: str, text_col: str) -> Column:
    """Where a row lies on its source's axis."""
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.md5(text_or_empty(text_col))))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, known, size, place``: the narrow table all else works on.

    ``place`` is a digest of id and text, so copies and rows without an id are spread as well.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.col(source_col).isNotNull().alias("known"),
        word_count(text_col).alias("size"),
        digest(id_col, text_col).alias("place"),
    )


def source_targets(rows: DataFrame, params: MixParams) -> DataFrame:
    """``source, known, rank, source_size, target`` for each source.

    Water-filling in closed form: by rising ``cap / weight``, the first source that its share of
    what the earlier, full sources leave does not fill sets the level of all later ones.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("known").desc(), "source")
    before = everything.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    weights = F.array(*[F.lit(w).cast("long") for w in params.weights])
    share = F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "rank", "level_here"))
    return (
        rows.groupBy("source", "known")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(params.weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * params.max_epochs)
        .withColumn("ratio", F.col("most").cast("double") / F.col("weight").cast("double"))
        .withColumn(
            "level_here",
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"),
        )
        .withColumn("level", F.min(share).over(everything)["level_here"])
        .withColumn("target", F.least(F.col("level") * F.col("weight").cast("double"), F.col("most").cast("double")))
        .select("source", "known", "rank", "source_size", "target")
    )


def with_slots(targets: DataFrame, block: int) -> DataFrame:
    """Add each source's blocks and its interval ``[low, high)`` of lattice points.

    Shares are counted in thousandths of a slot, as whole numbers.
    """
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    slots = F.col("target") * F.col("blocks").cast("double") / F.col("source_size").cast("double")
    edge = lambda x: F.floor(x.cast("double") / F.col("total").cast("double") * F.lit(float(LATTICE))).cast("long")
    return (
        targets.filter("source_size > 0")
        .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
        .withColumn("milli", F.round(slots * 1000.0).cast("long"))
        .withColumn("total", F.sum("milli").over(everything))
        .withColumn("upto", F.sum("milli").over(upto))
        .withColumn("low", edge(F.col("upto") - F.col("milli")))
        .withColumn("high", edge(F.col("upto")))
        .select("source", "known", "source_size", "blocks", "total", "low", "high")
    )


def lattice_point(slot: Column) -> Column:
    return (slot % LATTICE) * GOLDEN % LATTICE


def schedule(slots: DataFrame, params: MixParams) -> DataFrame:
    """``slot, source, known, epoch, block``: the order in which the mix reads blocks.

    Points meet their source by the cell of the lattice both lie in, about one source a cell. Slots
    past ``max_epochs`` readings of a source, two or three that the points may give too many, stay
    unused.
    """
    size = slots.agg(F.max("total").alias("total"), F.count("*").alias("n")).first()
    if not size.n:
        count, width = 0, LATTICE
    else:
        count, width = -(-size.total // 1000), max(1, LATTICE >> (2 * size.n).bit_length())
    cells = slots.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}")))
    )
    points = (
        slots.sparkSession.range(count)
        .withColumnRenamed("id", "slot")
        .withColumn("point", lattice_point(F.col("slot")))
        .withColumn("cell", F.expr(f"point div {width}"))
    )
    placed = points.join(cells, "cell").filter("point >= low and point < high").drop("cell", "point", "low", "high")
    ranked = running_total(
        placed, ["source", "known"], F.expr(f"slot div {params.slots_per_bucket}"), [F.col("slot")], F.lit(1), "nth"
    )
    return (
        ranked.withColumn("epoch", F.expr("nth div blocks"))
        .withColumn("block", F.col("nth") % F.col("blocks"))
        .filter(F.col("epoch") < params.max_epochs)
        .select("slot", "source", "known", "epoch", "block")
    )


def block_length(total_words: int, params: MixParams) -> int:
    return max(1, min(params.block_words, total_words // params.min_slots))


def mix(docs: DataFrame, params: MixParams = MixParams(), **columns: str) -> tuple[DataFrame, DataFrame]:
    """The mix's plan: ``(schedule, documents)``.

    ``schedule`` lists the slots in order. ``documents`` has a row per input row: ``doc_id, place,
    source`` (null again where it was), ``size, source_size, target, start`` (its first word on the
    source's axis), ``taken``: the words that the schedule's blocks read from it, repeats counted,
    and ``copies``: ``taken / size`` rounded, or how often a text without words is passed over.
    """
    rows = cut_lineage(sized(docs, **columns))
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).first()
    block = block_length(totals.words, params)
    targets = cut_lineage(source_targets(rows, params))
    slots = with_slots(targets, block)
    plan = schedule(slots, params)
    times = plan.groupBy("source", "known", "block").agg(F.count("*").alias("times"))

    bits = bucket_bits(totals.n, params.rows_per_bucket)
    bucket = F.shiftright(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), 32 - bits)
    laid = cut_lineage(
        running_total(
            rows, ["source", "known"], bucket, [F.col("place"), F.col("size")], F.col("size"), "start"
        )
    )
    last = f"(start + greatest(size, 1) - 1) div {block}"
    pieces = (
        laid.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(last))))
        .withColumn("words", F.expr(f"least(start + size, (block + 1) * {block}) - greatest(start, block * {block})"))
        .join(times, ["source", "known", "block"], "left")
        .withColumn("times", F.coalesce("times", F.lit(0)))
    )
    # repeated rows without words share a key and are counted; others have a start of their own
    key = ["source", "known", "start", "place", "doc_id", "size"]
    taken = pieces.groupBy(*key).agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"),
        F.max("times").alias("_times"),
        F.sum(F.when(F.expr(f"block = start div {block}"), 1).otherwise(0)).alias("_rows"),
    )
    copies = F.when(F.col("size") == 0, F.col("_times")).otherwise(
        F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("long")
    )
    documents = (
        taken.join(targets, ["source", "known"])
        .withColumn("copies", copies)
        .withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
        .withColumn("source", F.when(F.col("known"), F.col("source")))
        .select("doc_id", "place", "source", "size", "source_size", "target", "start", "taken", "copies")
    )
    return plan, documents


def mixed_documents(docs: DataFrame, params: MixParams = MixParams(), **columns: str) -> DataFrame:
    """Every row of ``docs``, with all its columns, as often as the mix's rounded copies say.

    Rows equal in id, text and source are interchangeable and share their copies evenly.
    """
    _, plan = mix(docs, params, **columns)
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"} | columns
    *keys, piece, copies, rows, before, nth, times = unused(
        docs, "place", "source", "known", "piece", "copies", "rows", "before", "nth", "times"
    )
    source, place = F.col(names["source_col"]), digest(names["id_col"], names["text_col"])
    key = lambda c, p: [p.alias(keys[0]), F.coalesce(c, F.lit("")).alias(keys[1]), c.isNotNull().alias(keys[2])]
    shares = plan.groupBy(*key(F.col("source"), F.col("place"))).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    # written, so that pieces of the input are the same wherever they are read
    tagged = cut_lineage(docs.select("*", *key(source, place), F.spark_partition_id().alias(piece)))
    earlier = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    pieces = tagged.groupBy(*keys, piece).agg(F.count("*").alias(before))
    pieces = pieces.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0))).join(shares, keys)
    # equal rows are numbered in the pieces they came in: one that is repeated often is spread
    within = F.row_number().over(Window.partitionBy(*keys, piece).orderBy(*keys))
    own = F.expr(f"cast({copies} div {rows} + if({nth} <= {copies} % {rows}, 1, 0) as int)")
    return (
        tagged.withColumn(nth, within)
        .join(pieces, [*keys, piece])
        .withColumn(nth, F.col(nth) + F.col(before))
        .withColumn(times, own)
        .filter(F.col(times) > 0)
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
