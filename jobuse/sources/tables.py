"""Dumps as tables bucketed by job and partitioned by period.

Tables with as many buckets lie alike: joins on the job id, and the distinct job
ids of a table, then need no shuffle, and a range of time reads only the folders
of its periods.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobuse.operators.filters import in_period

PERIOD = "period"
BUCKET_BYTES = 16 << 20     # bytes of input to a bucket, which one task joins


def bucket_count(size: int, least: int = 8) -> int:
    """Buckets for tables made of ``size`` bytes of input: tasks do not grow with it."""
    return max(least, math.ceil(size / BUCKET_BYTES))


def period_of(time: Column) -> Column:
    """The month of a time, as text in the order of time."""
    return F.date_format(time, "yyyy-MM")


def write_table(df: DataFrame, name: str, path: str, buckets: int, time: str | None = None,
                key: str = "job_id", mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as table ``name`` in ``path``, in ``buckets`` buckets of ``key``; returns the table.

    With a ``time`` column there is a folder for each of its months (rows without
    a time in one of their own). Rows are first shuffled as the buckets lie, so a
    bucket is one file in each month. All rows of a key are in one bucket.
    """
    if time:
        df = df.withColumn(PERIOD, period_of(F.col(time)))
    writer = df.repartition(buckets, key).write.mode(mode).option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(PERIOD) if time else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def attach_table(spark: SparkSession, name: str, path: str, columns: str, buckets: int, time: str | None = None,
                 key: str = "job_id") -> DataFrame:
    """Name a table that an earlier session wrote; ``columns`` are those of its rows, as in DDL."""
    schema = f"{columns}, {PERIOD} STRING" if time else columns
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE `{name}` ({schema}) USING parquet {f'PARTITIONED BY ({PERIOD})' if time else ''} "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    if time:
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
    return spark.table(name)


def rows_between(table: DataFrame, time: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= time < end``, from the folders of the months between; without the period."""
    if start is not None:
        table = table.filter(F.col(PERIOD) >= period_of(F.lit(start)))
    if end is not None:
        table = table.filter(F.col(PERIOD) <= period_of(F.lit(end)))
    return in_period(table, time, start, end).drop(PERIOD)
