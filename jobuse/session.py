"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time re-planning: merges small shuffle partitions, splits skewed join keys.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("jobuse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the whole session runs in one process may that be unset; then a
    folder below the warehouse is used, and removed when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _own_folder(spark)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    if not warehouse.startswith("/"):
        raise RuntimeError("set spark.checkpoint.dir: the warehouse is not a local folder")
    os.makedirs(warehouse, exist_ok=True)
    folder = tempfile.mkdtemp(prefix="scratch-", dir=warehouse)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


TASK_BYTES = 16 << 20       # shuffled bytes, compressed, that a task sorts: some 200 MB of rows as wide as facts
INPUT_BYTES = 4 << 20       # bytes of input to a shuffle partition, before small ones are merged


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files in some paths."""
    places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in places)


def fit_shuffles(spark: SparkSession, size: int) -> None:
    """Let shuffles have as many partitions as ``size`` bytes of input need, so that a task's part does not grow with them.

    Adaptive execution merges partitions up to its advisory size but cannot cut one, and its
    64 MB of much alike rows take a task close to a gigabyte. Settings are raised in
    parts and lowered in size only; a session set finer stays as it is.
    """
    advisory, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(advisory)) > TASK_BYTES:
        spark.conf.set(advisory, str(TASK_BYTES))
    parts = math.ceil(size / INPUT_BYTES)
    if parts > int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(first, str(parts))


READ_BYTES = 4 << 20        # bytes of files to a task: of compressed text, some 30 MB of lines (a file that cannot be cut is one task)


def fit_reads(spark: SparkSession) -> None:
    """Let a task read no more compressed text than it may plain text; a session set finer stays as it is."""
    name = "spark.sql.files.maxPartitionBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > READ_BYTES:
        spark.conf.set(name, str(READ_BYTES))


def made_folder(spark: SparkSession, path: str) -> str:
    """``path``, as an empty folder if there is none (nothing is written for a folder without rows)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy.

    For small aggregates that several later steps read: they are computed once
    and survive the loss of an executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Row groups of written tables: small enough for a few tasks to share a file, and for a writer's memory.
ROW_GROUP = 8 << 20


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` as a columnar table in the shared folder; Spark knows its size from then on."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).partitionBy(*partition_by).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def removed(table: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing is going to read any more."""
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a columnar table in the shared folder while several passes read it.

    The table is removed at the end of the block, so whatever is to outlive it
    must have been written (``cut``) inside it.
    """
    table = written(df)
    try:
        yield table
    finally:
        removed(table)
