"""Writers and the empty-input guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

ONE_DECIMAL = "%.1f"


def write_merged(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                 partition_by: list[str] | None = None) -> None:
    """The assembled fact table: parquet by default, or comma text with a header."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def one_decimal(df: DataFrame) -> DataFrame:
    """Fractional columns as text with one decimal; others unchanged.

    The formatter rounds ties up; printed tables round them to even. Ties at one
    decimal are the values with an odd number of quarters.
    """
    def text(value):
        tie = F.pmod(value * 4, F.lit(2.0)) == 1
        return F.when(value.isNotNull(), F.format_string(
            ONE_DECIMAL, F.when(tie, F.bround(value, 1)).otherwise(value)))

    return df.select([
        text(F.col(f"`{f.name}`").cast("double")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def result_path(folder: str, prefix: str, analysis: str, weighted: bool) -> str:
    return f"{folder}/{prefix}_{analysis}{'_weighted' if weighted else ''}.csv"


def write_result(df: DataFrame, folder: str, prefix: str, analysis: str,
                 weighted: bool = False, mode: str = "errorifexists") -> str:
    """A report table as ``<prefix>_<analysis>[_weighted].csv``, one decimal."""
    path = result_path(folder, prefix, analysis, weighted)
    one_decimal(df).write.mode(mode).option("header", True).csv(path)
    return path


def write_combined(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The combined table of several periods, largest use first, as comma text with a header and all digits."""
    df.write.mode(mode).option("header", True).csv(path)


def has_rows(df: DataFrame) -> bool:
    """False when there is nothing to analyse ("no jobs found")."""
    return not df.isEmpty()
