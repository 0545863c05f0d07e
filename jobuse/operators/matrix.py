"""Runtime x size matrices from scheduling-report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from jobuse.sources.report import SIZES

# What an absent cell of the report holds, and the hot share.
NO_WAIT = "0:0:0"
HOT_SHARE = 0.9

MEASURES = ["submitted", "ran", "usage", "wait", "coefficient"]


def dense(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """All runtime classes by all size classes.

    ``blocks`` are the runtime classes of the reports (``report_blocks``), also
    those without data rows. Sizes are the listed classes, then any others that a
    report has rows of, by name. Cells without jobs run or without a coefficient
    are masked: their coefficient and usage are NULL. A repeated size row of a
    block: the last wins.
    """
    key = ["file_path", "block", "runtime"]
    listed = F.array(*[F.lit(s) for s in SIZES])
    # A report is one file of a few lines, so its sizes are a short array.
    others = rows.filter(~F.col("size").isin(SIZES)).groupBy("file_path").agg(F.collect_set("size").alias("others"))
    sizes = F.concat(listed, F.coalesce(F.array_sort("others"), F.array().cast("array<string>")))
    grid = blocks.select(*key).join(others, "file_path", "left").select(*key, F.posexplode(sizes).alias("size_index", "size"))
    values = F.struct(*MEASURES)
    last = rows.groupBy(*key, "size").agg(F.max_by(values, "line").alias("m"))
    joined = grid.join(last.select(*key, "size", "m.*"), [*key, "size"], "left")
    masked = F.coalesce(F.col("ran"), F.lit(0)) == 0
    masked = masked | F.col("coefficient").isNull()
    return joined.select(
        *key, "size_index", "size",
        F.coalesce("submitted", F.lit(0)).cast("bigint").alias("submitted"),
        F.coalesce("ran", F.lit(0)).cast("bigint").alias("ran"),
        F.when(~masked, F.col("usage")).alias("usage"),
        F.coalesce("wait", F.lit(NO_WAIT)).alias("wait"),
        F.when(~masked, F.col("coefficient")).alias("coefficient"))


def hot(cells: DataFrame) -> DataFrame:
    """Flag cells above 0.9 of the largest usage in their report."""
    largest = F.max("usage").over(Window.partitionBy("file_path"))
    share = F.try_divide(F.col("usage"), largest)
    return cells.withColumn("hot", F.coalesce(share > HOT_SHARE, F.lit(False)))


def pivoted(cells: DataFrame, measure: str) -> DataFrame:
    """One row per runtime class, one column per listed size class; a size that is not listed is an error."""
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}, not {measure!r}")
    unlisted = F.raise_error(F.concat(F.lit("no column for size "), "size")).cast("string")
    checked = cells.withColumn("size", F.when(F.col("size").isin(SIZES), F.col("size")).otherwise(unlisted))
    return checked.groupBy("file_path", "block", "runtime").pivot("size", SIZES).agg(F.first(measure))
