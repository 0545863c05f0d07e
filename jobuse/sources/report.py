"""Scheduling report: blocks of size rows, one block per runtime class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The size classes of the report, in nodes.
SIZES = [
    "1", "2", "3-4", "5-8", "9-16", "17-32", "33-64", "65-128", "129-256", "257-512",
    "513-1024", "1025-2048", "2049-4096", "4097-8192",
]


def _checked(cell: Column, kind: str) -> Column:
    """A number of a data row; a missing or malformed one ends the read, naming its line."""
    value = cell.try_cast(kind)
    where = F.concat(F.lit("not a report row: "), "file_path", F.lit(", block "), F.col("block").cast("string"),
                     F.lit(", line "), F.col("line").cast("string"), F.lit(": "), "text")
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(where).cast(kind))


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of reports (``file_path, split, id, text``), in the order of their ids within a split.

    A split is what one task reads of a file, as long as
    ``spark.sql.files.maxPartitionBytes`` at most; ``split`` is where it starts.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))


def _runtime(text: Column) -> Column:
    return F.regexp_extract(text, r"^Runtime:\s*(\S+)", 1)


def with_blocks(lines: DataFrame) -> DataFrame:
    """Lines that lie in a block, with ``block``, ``runtime`` and ``line`` (the ``Runtime:`` line is 0).

    What a block's first line says is carried to the lines after it, across splits:
    each split is summarised in one row (its lines, heads, last head and last
    end of a block), a running pass over the summaries of a file gives what each
    split begins with, and lines are filled within their split. So a report of
    any length is read by many tasks, and a block of any length too.
    """
    head, end = F.col("text").startswith("Runtime:"), F.col("text").startswith(",")
    split = ["file_path", "split"]
    # Ids of a split follow each other without gaps, so they count lines.
    marks = {"last_head": F.max(F.when(head, F.col("id"))), "last_end": F.max(F.when(end, F.col("id"))),
             "last_runtime": F.max_by(_runtime(F.col("text")), F.when(head, F.col("id")))}
    summaries = lines.groupBy(*split).agg(F.min("id").alias("first_id"), F.count("*").alias("lines"), F.count_if(head).alias("heads"),
                                          *[c.alias(name) for name, c in marks.items()])
    before = Window.partitionBy("file_path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # Places of lines in the file, whatever split they are in.
    placed = summaries.withColumn("base", F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first_id"))
    carried = placed.select(
        *split, "base", F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("blocks_before"),
        *[F.last(c, ignorenulls=True).over(before).alias(name) for name, c in {
            "head_before": F.col("last_head") + F.col("base"), "end_before": F.col("last_end") + F.col("base"),
            "runtime_before": F.col("last_runtime")}.items()])
    so_far = Window.partitionBy(*split).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    filled = lines.join(carried, split).withColumn("place", F.col("id") + F.col("base")).withColumns({
        "block": F.col("blocks_before") + F.count_if(head).over(so_far) - 1,
        "head": F.coalesce(F.last(F.when(head, F.col("place")), ignorenulls=True).over(so_far), "head_before"),
        "end": F.coalesce(F.last(F.when(end, F.col("place")), ignorenulls=True).over(so_far), "end_before"),
        "runtime": F.coalesce(F.last(F.when(head, _runtime(F.col("text"))), ignorenulls=True).over(so_far), "runtime_before")})
    inside = filled.filter(F.col("head").isNotNull() & (F.col("end").isNull() | (F.col("end") < F.col("head"))))
    return inside.select("file_path", F.col("block").cast("int").alias("block"), "runtime",
                         (F.col("place") - F.col("head")).cast("int").alias("line"), "text")


def read_report(spark: SparkSession, path) -> DataFrame:
    """Data rows of reports. A short row or one whose numbers are none is an error.

    A block starts at a ``Runtime:`` line and ends at a line that starts with a comma.
    """
    lines = with_blocks(numbered_lines(spark, path)).filter(
        (F.col("line") > 0) & ~F.col("text").startswith("Nodes") & (F.trim("text") != ""))
    cell = F.split(F.rtrim("text"), ",")
    return lines.select(
        "file_path", "block", "line", "runtime",
        F.get(cell, F.lit(0)).alias("size"),
        _checked(F.get(cell, F.lit(1)), "bigint").alias("submitted"),
        _checked(F.get(cell, F.lit(2)), "bigint").alias("ran"),
        _checked(F.get(cell, F.lit(3)), "double").alias("usage"),
        F.get(cell, F.lit(5)).alias("wait"),
        _checked(F.get(cell, F.lit(6)), "double").alias("coefficient"),
    )


def report_blocks(spark: SparkSession, path) -> DataFrame:
    """The runtime classes themselves, including blocks without data rows."""
    return with_blocks(numbered_lines(spark, path)).filter("line = 0").select("file_path", "block", "runtime")
