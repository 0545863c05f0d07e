"""Scans of accounting dumps.

Every reader declares its schema, reads all columns as text, and turns missing
tokens to NULL once; numbers are converted later, leniently. For repeated
analyses write the merged table as parquet (``sinks.write_merged``) and start
from there: text files cannot prune columns or skip blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobuse.functions.scalars import job_id_of, normalise_na, sub_job_id_of

STEP_COLUMNS = [
    "job_id_raw", "exe_name", "user_name", "account", "nodes", "ntasks", "runtime",
    "state", "energy_j", "max_rss", "mean_rss", "cpu_freq",
]
ENERGY_COLUMNS = [
    "job_id_raw", "exe_name", "user_name", "account", "nodes", "runtime", "state", "energy_j",
]
USAGE_COLUMNS = ["job_id"] + STEP_COLUMNS[1:] + ["sub_job_id"]
USAGE_COLUMNS_GPU = ["job_id"] + STEP_COLUMNS[1:] + ["ngpus", "sub_job_id"]
SUMMARY_COLUMNS = [
    "key", "Min", "Q1", "Median", "Q3", "Max", "Jobs", "Nodeh", "PercentUse", "kWh",
    "PercentEnergy", "Users", "Projects",
]


RAW = "_raw"


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _delimited(spark: SparkSession, path, names: list[str]) -> DataFrame:
    # '::' keeps commas and quotes of job names out of the way, so quoting is off.
    return normalise_na(spark.read.csv(path, sep="::", schema=text_schema(names), quote=""))


def _comma(spark: SparkSession, path, names: list[str], header: bool, **options) -> DataFrame:
    return spark.read.options(**options).csv(path, header=header, schema=text_schema(names), enforceSchema=True,
                                             quote='"', escape='"')


def _file_position() -> Column:
    """Orders rows as they stand in the files they were read from."""
    return F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )


def last_by_key(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """One row per key, the last one in ``order``; combines before the shuffle.

    Where the last entry is a missing token the value is NULL.
    """
    return normalise_na(df.groupBy(key).agg(F.max_by(F.col(value), order).alias(value)))


def _entries(spark: SparkSession, path, names: list[str], header: bool) -> DataFrame:
    """Entries of a map file with their position; short rows are skipped, empty values are not."""
    rows = _comma(spark, path, [*names, RAW], header=header, ignoreLeadingWhiteSpace=True,
                  columnNameOfCorruptRecord=RAW, columnPruning="false")
    # The line itself is kept of rows that are short or long; only a short one has no comma.
    # (Were unused columns left out of the scan, short rows would not be noticed.)
    return rows.withColumn("_at", _file_position()).filter(F.col(RAW).isNull() | F.contains(RAW, F.lit(","))).drop(RAW)


def read_steps(spark: SparkSession, path) -> DataFrame:
    """Step dump: ``::``-delimited, no header, ids of the form ``job.step``."""
    return _delimited(spark, path, STEP_COLUMNS)


def read_jobs(spark: SparkSession, path) -> DataFrame:
    """Job dump: the step layout, with allocated CPUs in the ``ntasks`` column."""
    return _delimited(spark, path, STEP_COLUMNS)


def read_energy_jobs(spark: SparkSession, path, merged: bool = False) -> DataFrame:
    """Whole-job dump with energy: raw (``::``) or merged (comma and header)."""
    raw = (normalise_na(_comma(spark, path, ENERGY_COLUMNS, header=True)) if merged
           else _delimited(spark, path, ENERGY_COLUMNS))
    return raw.withColumn("job_id", job_id_of(F.col("job_id_raw"))).drop("job_id_raw")


def read_usage(spark: SparkSession, path, gpu: bool = False) -> DataFrame:
    """Merged usage file: its header is skipped and names go by position."""
    names = USAGE_COLUMNS_GPU if gpu else USAGE_COLUMNS
    return normalise_na(_comma(spark, path, names, header=True))


def read_user_map(spark: SparkSession, path) -> DataFrame:
    """job id -> user; short rows are skipped and the last entry of a job wins."""
    rows = _entries(spark, path, ["job_id_raw", "user_name"], True).withColumn(
        "job_id", F.col("job_id_raw").try_cast("bigint"))
    return last_by_key(rows.filter(F.col("job_id").isNotNull()), "job_id", "user_name", F.col("_at"))


def read_step_exe(spark: SparkSession, path, header: bool = False) -> DataFrame:
    """job id -> executable of a step (``job.step,exe``); the last entry wins."""
    rows = _entries(spark, path, ["job_id_raw", "exe_name"], header).withColumn(
        "job_id", job_id_of(F.col("job_id_raw")))
    return last_by_key(rows.filter(F.col("job_id").isNotNull()), "job_id", "exe_name", F.col("_at"))


def read_step_exe_rows(spark: SparkSession, path, header: bool = False) -> DataFrame:
    """All (job.step, executable) entries with their ``position`` in the files."""
    rows = normalise_na(_entries(spark, path, ["job_id_raw", "exe_name"], header))
    return rows.withColumnRenamed("_at", "position")


def read_areas(spark: SparkSession, path) -> DataFrame:
    """project id -> research area; the first line is a header, the last entry wins."""
    rows = _comma(spark, path, ["project_id", "area"], header=True, ignoreLeadingWhiteSpace=True)
    rows = rows.withColumn("_at", _file_position()).filter(F.col("area").isNotNull())
    return last_by_key(rows, "project_id", "area", F.col("_at"))


def read_gpu_alloc(spark: SparkSession, path) -> DataFrame:
    """GPU dumps of steps and of jobs: id, state, allocation string (rest of the line)."""
    parts = F.split(F.col("value"), ",", 3)
    rows = spark.read.text(path).select(
        parts.getItem(0).alias("job_id_raw"),
        F.get(parts, F.lit(1)).alias("state"),
        F.get(parts, F.lit(2)).alias("allocation"),
    )
    return normalise_na(rows)


def read_summaries(spark: SparkSession, folder: str, pattern: str, key: str = "key") -> DataFrame:
    """All tables ``<folder>/*<pattern>.csv``, whether single files or written results.

    Columns go by name: tables may order them differently, lack some or have
    others, which are left out. The files of each header are read together.
    """
    where = f"{folder}/*{pattern.strip()}.csv"
    headers = spark.read.text(where, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.regexp_extract("value", r"\A([^\r\n]*)", 1).alias("header"))
    # One row a layout; file names are on the driver in any case, to plan the scan.
    layouts = headers.filter("header <> ''").groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    tables = []
    for layout in layouts.orderBy("header").collect():
        rows = spark.read.csv(layout["files"], header=True, enforceSchema=False)
        if key not in rows.columns:
            raise ValueError(f"no column {key!r} in {layout['files'][0]}")
        tables.append(rows.select(F.col(f"`{key}`"), *[
            F.col(c).try_cast("double").alias(c) for c in SUMMARY_COLUMNS[1:] if c in rows.columns]))
    if not tables:
        raise ValueError(f"no tables at {where}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_job_ids(rows: DataFrame) -> DataFrame:
    """Split ``job_id_raw`` into a numeric job id and a text sub-job id."""
    raw = F.col("job_id_raw")
    return rows.select(job_id_of(raw).alias("job_id"), sub_job_id_of(raw).alias("sub_job_id"),
                       *[c for c in rows.columns if c != "job_id_raw"])
