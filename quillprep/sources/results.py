"""Score records: JSON lines, and the committed slices beside them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quillprep.sources.store import RECORD_SCHEMA, read_slices


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All records under a path, JSON lines and committed slices; none if it does not exist."""
    return read_lines(spark, path).unionByName(read_slices(spark, path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records in JSON lines under a path; none if it does not exist.

    Blank lines are skipped. A line torn by a crash is left out, so its example is redone.
    """
    torn = "_corrupt_record"
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField(torn, T.StringType())])
    try:
        lines = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD_SCHEMA)
    whole = F.col(torn).isNull() & F.col("index").isNotNull()
    return lines.filter(whole).select(*RECORD_SCHEMA.fieldNames())


def append_results(records: DataFrame, path: str) -> None:
    """Append finished records as JSON lines; each run has its own folder."""
    records.write.mode("append").partitionBy("run_id").json(path)
