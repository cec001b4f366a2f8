"""Column expressions and running totals that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# What a word and what a gap between words is.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: str) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def words(text: str) -> Column:
    """Words of a text in order; an empty array for null."""
    return F.filter(F.split(text_or_empty(text), GAP), lambda w: w != "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have, made from these."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bucket_bits(rows: int, per_bucket: int) -> int:
    """How many hash bits give buckets of about ``per_bucket`` rows."""
    return max(0, -(-rows // per_bucket) - 1).bit_length()


def running_total(
    df: DataFrame, group: list[str], bucket: Column, order: list[Column], amount: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the earlier rows of the same group.

    ``bucket`` must follow the order of ``order`` and cut each group into small pieces. Pieces are
    summed with map-side combining, their sums are accumulated (a row per piece), and rows are only
    sorted inside a piece, so a group of any size is spread. ``group`` columns must not be null.
    """
    at, add, base, within = unused(df, "bucket", "amount", "base", "within")
    tagged = df.withColumn(at, bucket).withColumn(add, amount.cast("long"))
    earlier = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        tagged.groupBy(*group, at)
        .agg(F.sum(add).alias(base))
        .select(*group, at, F.coalesce(F.sum(base).over(earlier), F.lit(0)).alias(base))
    )
    inside = Window.partitionBy(*group, at).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.withColumn(within, F.coalesce(F.sum(add).over(inside), F.lit(0)))
        .join(bases, [*group, at])
        .withColumn(name, F.col(base) + F.col(within))
        .drop(at, add, within, base)
    )
