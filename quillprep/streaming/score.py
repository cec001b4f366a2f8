"""Incremental scoring: one record for each key, in the folder of the micro-batch it came with.

Which keys have come is kept in the query's state, so a micro-batch reads nothing that was scored
before. The state lives in the checkpoint: output path and checkpoint belong together. ``start_score`` remembers keys for
ever, ``start_score_remembering`` for a time after they came, in RocksDB, so its state is bounded by what arrives in that time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quillprep.operators.runs import RECORD_KEY
from quillprep.operators.scoring import score_records
from quillprep.params import EvalParams
from quillprep.sources.results import RECORD_SCHEMA


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """Records of all micro-batches with their ``batch_id``; none before the first."""
    columns = [*RECORD_SCHEMA.fieldNames(), "batch_id"]
    try:
        return spark.read.schema(RECORD_SCHEMA).parquet(path).select(*columns)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN.WITH_SUGGESTION"):
            raise
        empty = spark.createDataFrame([], RECORD_SCHEMA)
        return empty.withColumn("batch_id", F.lit(None).cast("int"))


def score_batch(batch: DataFrame, batch_id: int, path: str, params: EvalParams) -> None:
    """Score a micro-batch into its own folder; a replay after a crash writes it again in full."""
    records = score_records(batch, params)
    records.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def start_score(
    predicted: DataFrame, path: str, checkpoint: str, params: EvalParams
) -> StreamingQuery:
    """Score arriving ``run_id, index, prediction, reference`` rows, then stop.

    One row for each ``run_id, index`` is scored: of those in the first micro-batch that has the
    key, the state keeps one, and later ones are dropped.
    """
    return _start(predicted.dropDuplicates(RECORD_KEY), path, checkpoint, params)


def start_score_remembering(
    predicted: DataFrame, path: str, checkpoint: str, params: EvalParams, remembered: str = "1 day"
) -> StreamingQuery:
    """The same with a state that forgets: a key that comes again within ``remembered`` of its first time is dropped.

    Time is that of arrival, so late rows are like any others. A key is forgotten once the stream has gone on for between
    one and two times ``remembered``; if it comes again after that, it is scored again, and ``first_scored`` keeps
    the record of the earliest micro-batch.
    """
    arrived = predicted.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remembered)
    once = arrived.dropDuplicatesWithinWatermark(RECORD_KEY).drop("_arrived")
    with _rocksdb(predicted.sparkSession):
        return _start(once, path, checkpoint, params)


def first_scored(scored: DataFrame) -> DataFrame:
    """One record for each key, that of the earliest micro-batch; batches are compared without texts."""
    earliest = scored.groupBy(*RECORD_KEY).agg(F.min("batch_id").alias("batch_id"))
    return scored.join(earliest, [*RECORD_KEY, "batch_id"]).select(*scored.columns)


def _start(once: DataFrame, path: str, checkpoint: str, params: EvalParams) -> StreamingQuery:
    return (
        once.writeStream.foreachBatch(lambda b, n: score_batch(b, n, path, params))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: on local disk, with changes in the checkpoint."""
    own = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
