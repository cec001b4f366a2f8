"""Score records in slices that are committed whole, once each.

A slice is written by a data source of Spark's Python API. Its tasks write files of their own and report
them; only when all have ended does the commit write one manifest, which names the slice, its files and, as bitmaps,
the positions that it finishes. Readers go by manifests alone: a job that is killed or fails leaves nothing they see,
files of lost or repeated tasks are in no manifest, and a slice that is committed again replaces itself.

Layout under a store's path, in folders that Spark's readers pass over, so that JSON lines may lie beside them:

    _slices/<run>/<attempt>/<slice>/<write>/<task>.parquet
    _commits/<run>/<attempt>/<slice>.json
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("reference", T.StringType()),
        T.StructField(
            "scores",
            T.StructType(
                [T.StructField(k, T.DoubleType()) for k in ("rouge1", "rouge2", "rougeL")]
            ),
        ),
    ]
)

FORMAT = "quillprep_slice"
# Positions of a bitmap, as Spark's bitmap functions have them.
BITS = 32_768

MANIFEST = (
    "run_id string, attempt int, slice string, records long, files array<string>, "
    "positions array<struct<bucket: long, bitmap: string>>"
)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _name(value: str) -> str:
    """A folder or file name for any text."""
    return "s-" + quote(value, safe="")


@dataclass
class Written(WriterCommitMessage):
    """What a task has written."""

    file: str | None
    records: int
    positions: dict[int, bytes]


class SliceWriter(DataSourceArrowWriter):
    """Tasks write a file each; the commit publishes them all at once, an abort removes them."""

    def __init__(self, options: dict[str, str]) -> None:
        self.base = options["path"].rstrip("/")
        self.run_id, self.attempt, self.slice = options["run_id"], int(options["attempt"]), options["slice"]
        self.place = "/".join(map(_name, (self.run_id, str(self.attempt), self.slice)))
        self.folder = f"{self.base}/_slices/{self.place}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task = TaskContext.get()
        store, folder = _filesystem(self.folder)
        path = f"{folder}/{task.partitionId()}-{task.taskAttemptId()}.parquet"
        writer, records, positions = None, 0, {}
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(store.open_output_stream(path), batch.schema, compression="zstd")
                writer.write_batch(batch)
                records += batch.num_rows
                _mark(positions, batch.column("index").to_numpy(zero_copy_only=False))
        except BaseException:
            if writer is not None:
                writer.close()
                store.delete_file(path)
            raise
        if writer is not None:
            writer.close()
        return Written(f"{self.folder}/{path.rsplit('/', 1)[1]}" if writer else None, records, {b: m.tobytes() for b, m in positions.items()})

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        positions: dict[int, np.ndarray] = {}
        for m in done:
            for bucket, bitmap in m.positions.items():
                held = positions.setdefault(bucket, np.zeros(BITS // 8, np.uint8))
                held |= np.frombuffer(bitmap, np.uint8)
        manifest = {
            "run_id": self.run_id,
            "attempt": self.attempt,
            "slice": self.slice,
            "records": sum(m.records for m in done),
            "files": [m.file for m in done if m.file],
            "positions": [{"bucket": b, "bitmap": base64.b64encode(m).decode()} for b, m in sorted(positions.items())],
        }
        store, path = _filesystem(f"{self.base}/_commits/{self.place}.json")
        folder = path.rsplit("/", 1)[0]
        store.create_dir(folder, recursive=True)
        # readers pass over names with a leading underscore; the move publishes the whole manifest
        hidden = f"{folder}/_{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as out:
            out.write(json.dumps(manifest).encode())
        store.move(hidden, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = _filesystem(self.folder)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def _mark(positions: dict[int, np.ndarray], index: np.ndarray) -> None:
    """Set the bits of positions in the bitmaps of their buckets."""
    for bucket in np.unique(index // BITS).tolist():
        bits = np.zeros(BITS, bool)
        bits[index[index // BITS == bucket] % BITS] = True
        held = positions.setdefault(bucket + 1, np.zeros(BITS // 8, np.uint8))
        held |= np.packbits(bits, bitorder="little")


class SliceSource(DataSource):
    """The write side of the store; readers go by manifests and read the files themselves."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return RECORD_SCHEMA

    def writer(self, schema: T.StructType, overwrite: bool) -> SliceWriter:
        return SliceWriter(dict(self.options))


def commit_slice(records: DataFrame, path: str, run_id: str, slice_name: str, attempt: int = 0) -> None:
    """Write the records of one slice of a run's attempt and publish them, in place of an earlier write of the same slice.

    ``index`` must not be null or negative.
    """
    spark = records.sparkSession
    spark.dataSource.register(SliceSource)
    known = F.col("index").isNotNull() & (F.col("index") >= 0)
    checked = F.when(known, F.col("index")).otherwise(F.raise_error(F.lit("records need an index of 0 or more")).cast("long"))
    rows = records.select(
        F.lit(run_id).alias("run_id"), checked.alias("index"), F.lit(attempt).alias("attempt"), "prediction", "reference", F.col("scores").cast(RECORD_SCHEMA["scores"].dataType)
    )
    writer = rows.write.format(FORMAT).mode("append").option("path", path)
    writer.option("run_id", run_id).option("attempt", str(attempt)).option("slice", slice_name).save()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each committed slice; none if there is no store."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{path.rstrip('/')}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """Records of the committed slices. The driver lists their files' names."""
    files = [r.file for r in manifests(spark, path).select(F.explode("files").alias("file")).toLocalIterator()]
    if not files:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(*files)


def finished(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, bucket, bitmap`` of what each run's committed slices finish, from the manifests alone."""
    each = manifests(spark, path).select("run_id", F.explode("positions").alias("p"))
    bitmaps = each.select("run_id", F.col("p.bucket").alias("bucket"), F.unbase64("p.bitmap").alias("bitmap"))
    return bitmaps.groupBy("run_id", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def finished_of(records: DataFrame) -> DataFrame:
    """The same for any records, from their keys."""
    place = F.col("index") + 1  # buckets start at 1
    return records.groupBy("run_id", F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )


def is_set(bitmap: Column, index: Column) -> Column:
    """Whether a position's bit is set in the bitmap of its bucket."""
    bit = F.bitmap_bit_position(index + 1)
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def remaining_by_bitmap(todo: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Examples of ``todo`` whose bit is not set for their run; ``bitmaps`` as ``finished`` gives them.

    A bitmap of 4 KB stands for 32,768 examples, so this side is thousands of times smaller than records or keys.
    """
    bucket = F.bitmap_bucket_number(F.col("index") + 1)
    known = bitmaps.select("run_id", F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    met = todo.withColumn("_bucket", bucket).join(known, ["run_id", "_bucket"], "left")
    left = F.col("_bitmap").isNull() | ~is_set(F.col("_bitmap"), F.col("index"))
    return met.filter(left).select(*todo.columns)
