"""Helpers shared by the operators."""

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobuse.session import shared_dir

# Words are runs of anything but the six ASCII white-space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of bounded bytes, so long texts don't pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: for rows too many for ``cut``, in compressed columns."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_key(id_col: Column, text_col: Column) -> Column:
    """A never-null 64-bit key of a row's id and text: rows alike in both share it."""
    return F.xxhash64(id_col.cast("string"), text_col)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def worker_state() -> types.SimpleNamespace:
    """What a Python worker keeps from task to task (caches of loaded models)."""
    return sys.modules.setdefault("_jobuse_worker", types.SimpleNamespace())
