"""Row selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.config import UsageConfig
from jobuse.functions.scalars import power_is_missing


def real_steps(df: DataFrame, raw: str = "job_id_raw") -> DataFrame:
    """Numbered steps only (no batch or extern entries)."""
    return df.filter(F.col(raw).rlike(r"^[0-9]+\.[0-9]"))


def first_steps(df: DataFrame, raw: str = "job_id_raw") -> DataFrame:
    return df.filter(F.col(raw).rlike(r"^[0-9]+\.0$"))


def kept_states(df: DataFrame, cfg: UsageConfig = UsageConfig()) -> DataFrame:
    """Drop jobs whose state is excluded; rows without a state stay."""
    return df.filter(~F.coalesce(F.col("state").rlike(cfg.exclude_states), F.lit(False)))


# The partitions energy reports look at by default.
ENERGY_PARTITIONS = ["standard", "highmem"]


def in_period(df: DataFrame, time: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= time < end``; the comparison reaches the parquet scan."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(time) < F.lit(end))
    return df


def with_attributes(df: DataFrame, **wanted: str | Iterable[str]) -> DataFrame:
    """Keep rows whose columns are in the given lists (group, user, QoS, partition)."""
    for name, values in wanted.items():
        values = [values] if isinstance(values, str) else list(values)
        df = df.filter(F.col(name).isin(values))
    return df


def of_project(df: DataFrame, account: str | None) -> DataFrame:
    return df.filter(F.col("project_id") == account) if account else df


def complete_rows(df: DataFrame, read_columns: list[str]) -> DataFrame:
    """Drop rows with any missing value among the read columns or in node power."""
    power = power_is_missing(F.col("energy_j"), F.col("runtime"), F.col("nodes"))
    return df.dropna("any", subset=read_columns).filter(~power)


def gpu_rows(df: DataFrame) -> DataFrame:
    """Allocations that name a GPU."""
    return df.filter(F.col("allocation").contains("gpu"))


def is_full_node(cfg: UsageConfig) -> Column:
    if cfg.gpu:
        return F.coalesce(F.col("ngpus") >= cfg.gpn, F.lit(False))
    return F.coalesce(F.col("cores") >= cfg.cpn, F.lit(False))


def without_labels(df: DataFrame, column: str, labels=("Overall", "Unidentified")) -> DataFrame:
    return df.filter(~F.col(f"`{column}`").isin(list(labels)))
