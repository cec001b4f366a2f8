"""Whole Arrow batches as Python lists, without pandas' detour for nulls in integer columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Lists = dict[str, Any]


def map_lists(df: DataFrame, rows: Callable[[Iterator[Lists]], Iterator[Lists]], schema: str) -> DataFrame:
    """``rows`` gets each batch as ``{column: values}`` and yields batches of ``schema`` the same way."""
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ({name: column.to_pylist() for name, column in zip(b.schema.names, b.columns, strict=True)} for b in batches)
        for out in rows(lists):
            given = [(out[f.name], f.type) for f in fields]
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, kind, from_pandas=False) for x, kind in given]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, column: str, judge: Callable[[], Callable[[Any], bool]]) -> DataFrame:
    """The rows, all columns untouched, for which ``judge()``, made once a task, accepts ``column``."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = judge()
        for b in batches:
            yield b.filter(pa.array([bool(accepts(v)) for v in b.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
