"""Session helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import quillprep


def local_session(cores: str = "8", memory: str = "12g", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillprep")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def expose_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    For executors that see the same path; elsewhere install it or pass it with ``--py-files``.
    """
    home = str(Path(quillprep.__file__).parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *paths])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    ``spark.checkpoint.dir`` decides. Only a local session without it gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="quillprep-")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, survives executors.

    Unlike ``checkpoint()`` this runs the plan a single time, and the size on disk is known to
    the planner afterwards.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
