"""Exact reports over any range of periods, from what each period has stored.

Summaries of periods can be added up, but give neither the quartiles nor the
distinct users and projects of a longer time. So a period stores its grouped
facts instead: one row for each combination of executable, user, project, CPU
frequency and size, with its rows, the parts of the exact sums and where it
appeared first. Whole numbers add up in any order; a report over several periods
is therefore the report over their facts, to the last bit, whatever dictionary or
area table it is made with. For reports on node power the grouping includes power,
which makes the stored table about as long as the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobuse.config import UsageConfig
from jobuse.operators import stats
from jobuse.operators.identity import first_seen
from jobuse.plans.analyses import analyses_of, distributions_of, report_table

GROUPED_BY = ["exe_name", "user_name", "project_id", "cpu_freq"]


def write_periods(facts: DataFrame, period: Column, cfg: UsageConfig, folder: str, power: bool = False) -> None:
    """Add the grouped facts of each period (a name) to ``folder``, one partition a period.

    A period is written once, from all its facts: writing it again would count them twice.
    """
    keys = [c for c in [*GROUPED_BY, cfg.size_measure] if c in facts.columns]
    if power:
        keys.append("node_power")       # full nodes are told by the size measure
    named = facts.withColumn("period", period.cast("string"))
    grouped = stats.pregrouped(named, [*dict.fromkeys(keys), "period"], first_seen())
    grouped.write.mode("append").option("parquet.block.size", 32 << 20).partitionBy("period").parquet(folder)


def read_periods(spark: SparkSession, folder: str, periods: list[str] | None = None) -> DataFrame:
    """The grouped facts of some periods, or of all; others are not read."""
    paths = [folder] if periods is None else [f"{folder}/period={p}" for p in periods]
    return spark.read.option("basePath", folder).parquet(*paths).drop("period")


def reports_over(spark: SparkSession, folder: str, names: list[str], cfg: UsageConfig, periods: list[str] | None = None,
                 weighted: bool = False, **inputs) -> dict[str, DataFrame]:
    """The named reports over several periods, by name (``inputs`` as for ``distributions_of``)."""
    asked = [analyses_of(cfg)[name] for name in names]
    found = distributions_of(read_periods(spark, folder, periods), asked, cfg, is_stored=True, **inputs)
    return {a.name: report_table(d, a, cfg, weighted) for a, d in zip(asked, found)}
