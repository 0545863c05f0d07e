"""Combining the summary tables of several periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.operators.stats import OVERALL_LABEL
from jobuse.session import cut


def _sum(column: str) -> Column:
    """Sum of the values of a key in ascending order, so that it is the same however rows are spread.

    A key has one value in each period that is combined.
    """
    return F.aggregate(F.array_sort(F.collect_list(column)), F.lit(0.0), lambda a, x: a + x)


def combine_summaries(summaries: DataFrame, key: str = "key") -> DataFrame:
    """Sums of energy and use by key, with the range of users and projects.

    Distinct counts of different periods cannot be added, hence minimum and
    maximum. Shares are of the ``Overall`` key; without one they are NULL.
    """
    combined = cut(summaries.filter(F.col(key).isNotNull()).groupBy(key).agg(
        _sum("kWh").alias("kWh"), _sum("Nodeh").alias("Nodeh"),
        F.min("Users").alias("Users_min"), F.max("Users").alias("Users_max"),
        F.min("Projects").alias("Projects_min"), F.max("Projects").alias("Projects_max")))
    overall = combined.filter(F.col(key) == OVERALL_LABEL).agg(
        F.struct(F.max("kWh").alias("kWh"), F.max("Nodeh").alias("Nodeh")).alias("t"))
    return combined.withColumn("_t", overall.scalar()).select(
        "*", F.try_divide(F.col("kWh") * 100, F.col("_t.kWh")).alias("PercentEnergy"),
        F.try_divide(F.col("Nodeh") * 100, F.col("_t.Nodeh")).alias("PercentUse"),
    ).drop("_t").orderBy(F.desc("Nodeh"), F.asc(key))
