"""Totals and data-quality reports: one aggregate each, no grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.config import UsageConfig
from jobuse.functions.scalars import JOULES_PER_KWH, exact_sum


def _sum(value: Column) -> Column:
    return exact_sum(value).cast("double")


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100, whole)


def totals(facts: DataFrame, cfg: UsageConfig) -> DataFrame:
    return facts.agg(
        (_sum(F.col("use_s")) / cfg.use_divisor).alias("total_use"),
        (_sum(F.col("energy_j")) / JOULES_PER_KWH).alias("total_kwh"))


def energy_quality(facts: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Rows without an energy reading and their use."""
    missing = F.col("energy_j").isNull()
    sums = facts.agg(
        F.count("*").alias("rows"), F.count_if(missing).alias("missing_rows"),
        _sum(F.col("use_s")).alias("use"), _sum(F.when(missing, F.col("use_s"))).alias("missing_use"))
    return sums.select(
        "rows", "missing_rows",
        _percent(F.col("missing_rows"), F.col("rows")).alias("missing_rows_percent"),
        (F.col("missing_use") / cfg.use_divisor).alias("missing_use"),
        _percent(F.col("missing_use"), F.col("use")).alias("missing_use_percent"))


def node_power_quality(facts: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Rows below a full node, which power reports leave out, with use and energy."""
    small = F.coalesce(F.col("cores") < cfg.cpn, F.lit(False))
    sums = facts.agg(
        F.count("*").alias("rows"), F.count_if(small).alias("excluded_rows"),
        _sum(F.col("use_s")).alias("use"), _sum(F.when(small, F.col("use_s"))).alias("small_use"),
        _sum(F.col("energy_j")).alias("energy"),
        _sum(F.when(small, F.col("energy_j"))).alias("small_energy"))
    return sums.select(
        "rows", "excluded_rows",
        _percent(F.col("excluded_rows"), F.col("rows")).alias("excluded_rows_percent"),
        (F.col("small_use") / cfg.use_divisor).alias("excluded_use"),
        _percent(F.col("small_use"), F.col("use")).alias("excluded_use_percent"),
        (F.col("small_energy") / JOULES_PER_KWH).alias("excluded_kwh"),
        _percent(F.col("small_energy"), F.col("energy")).alias("excluded_kwh_percent"))


def distinct_values(facts: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of several columns as (column, value), in one pass."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return facts.select(entries.alias("e")).select("e.column", "e.value").distinct()
