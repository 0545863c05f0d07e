"""Joins on keys of which a few hold a large part of the rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

TRACKED = 10_000     # keys the counting sketch keeps
MOST = 256           # keys that may be split: more cannot each hold a large part
PARTS = 32           # parts to a shuffle partition's share of rows; small parts spread evenly


@dataclass(frozen=True)
class HotKeys:
    """Keys (None: null) and the number of parts each is split into."""

    key: str
    parts: dict[int | None, int]


def hot_keys(rows: DataFrame, key: str = "job_id") -> HotKeys:
    """The keys that hold more rows than a quarter of a shuffle partition's share.

    One pass over ``key`` alone fills a sketch of frequent items, combined on the map side;
    at most ``MOST`` keys with their counts reach the driver. Counts of a sketch are
    estimates: a key that is missed is only joined unsplit, so results never depend on them.
    A key's parts follow its share of the rows, so all parts together are a small multiple of
    the partitions.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"),
                     F.expr(f"approx_top_k(`{key}`, {MOST}, {TRACKED})").alias("top")).first()
    counts = {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None}
    share = found["rows"] / partitions
    return HotKeys(key, {k: math.ceil(PARTS * n / share) for k, n in [*counts.items(), (None, found["nulls"])] if n > share / 4})


def join_split(rows: DataFrame, values: DataFrame, on: list[str], hot: HotKeys, how: str = "left") -> DataFrame:
    """``rows`` joined to ``values`` (left, inner, semi or anti), with the rows of hot keys split.

    A row of a hot key goes to one of the key's parts by a hash of its columns, so a
    repeated task sends it there again; the values of a hot key are repeated once for each
    part. Rows alike in all columns share a part. Rows with a null key have no match and are
    spread in the same way. Both sides must have the column ``hot.key`` among ``on``.
    """
    if not hot.parts:
        return rows.join(values, on, how)
    known = [(k, n) for k, n in hot.parts.items() if k is not None]

    def parts(df: DataFrame):
        n = F.lit(1)
        if known:
            table = F.create_map(*(F.lit(x) for pair in known for x in pair))
            n = F.coalesce(F.try_element_at(table, F.coalesce(F.col(hot.key), F.lit(known[0][0]))), n)
        return F.when(F.col(hot.key).isNull(), F.lit(hot.parts.get(None, 1))).otherwise(n)

    part = "_part"
    while part in rows.columns or part in values.columns:
        part = "_" + part
    chosen = rows.withColumn(part, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), parts(rows)).cast("int"))
    repeated = values.filter(F.col(hot.key).isNotNull()).withColumn(part, F.explode(F.sequence(F.lit(0), parts(values) - 1)))
    return chosen.join(repeated, [*on, part], how).drop(part)
