"""Training-set export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillprep.operators.packing import pack
from quillprep.params import PrepParams

ROWS_PER_FILE = 50_000


def lay_out(examples: DataFrame, order: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Partition and sort by a dense position, ``rows_per_file`` rows of one split each.

    Partition numbers follow from the positions, so nothing is sampled to find range bounds and
    the examples are computed once.
    """
    # one row per split
    last = dict(examples.groupBy("split").agg(F.max(order)).collect())
    first_file, files = {}, 0
    for split in sorted(last):
        first_file[split] = files
        files += last[split] // rows_per_file + 1
    number = F.lit(None).cast("int")
    for split, first in first_file.items():
        own = (F.floor(F.col(order) / rows_per_file) + first).cast("int")
        number = F.when(F.col("split") == split, own).otherwise(number)
    return examples.repartitionById(max(files, 1), number).sortWithinPartitions("split", order)


def export_training_set(
    examples: DataFrame,
    path: str,
    params: PrepParams,
    order: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write ``prompt_ids, target_ids`` as packed training columns, one folder per split.

    With ``order``, a trainer that reads a split's files in name order sees that order. Rows are
    shuffled before they are packed: padding, masks and labels never cross the network.
    """
    keep = ["split", *([order] if order else []), "prompt_ids", "target_ids"]
    rows = examples.select(*keep)
    if order:
        rows = lay_out(rows, order, rows_per_file)
    pack(rows, params).write.partitionBy("split").parquet(path)
