"""Joins to lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobuse.session import written

BROADCAST_ROWS = 100_000    # rows of a table that any driver has room for


def by_rows(table: DataFrame, rows: int) -> DataFrame:
    """A side of a join that is never broadcast where it has many ``rows``.

    Spark plans with the bytes of files, and names that are much alike take a small
    part of the bytes there that they take as rows in memory.
    """
    return table if rows <= BROADCAST_ROWS else table.hint("merge")


def lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup table with unique keys.

    The table is written once, so Spark plans with its bytes: below
    ``spark.sql.autoBroadcastJoinThreshold`` (and ``BROADCAST_ROWS``) it is broadcast,
    beyond that both sides are shuffled and adaptive execution splits a hot key.
    """
    table = written(table)
    return rows.join(by_rows(table, table.count()), key, "left")
