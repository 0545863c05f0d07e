"""Anonymous user labels and per-user application labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobuse.config import UsageConfig
from jobuse.functions.scalars import EXACT_SUM, exact_sum, from_limbs, step_order
from jobuse.operators.classify import UNKNOWN, with_classes
from jobuse.session import cut
from jobuse.sources.definitions import Dictionary

# Applications whose use is split by user.
SPLIT_SOFTWARE = ["a.out", "Python"]

ROW_BITS = 33   # monotonically_increasing_id keeps the row number in the low 33 bits


def dense_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in ``order`` without moving them to one task.

    The rows are range-sorted and written once; numbers follow from the position
    in the sorted partition plus the sizes of the partitions before it.
    """
    ranked = cut(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = ranked.select(
        "*", F.shiftright("_id", ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_at"))
    # One row per sorted partition, so at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(sizes), "_part").select(
        *df.columns, (F.col("_before") + F.col("_at")).alias(name))


def first_seen(grouped: bool = False) -> Column:
    """Where a group of facts (or of facts ``grouped`` before) appears first, as an aggregate.

    Appearance follows the order of the assembled table: steps before step-less
    jobs, then job and step id, both by number.
    """
    if grouped:
        return F.min("_first").alias("_first")
    return F.min(F.struct("src", "job_id", step_order(F.col("sub_job_id")))).alias("_first")


def anonymous_users(facts: DataFrame) -> DataFrame:
    """(user_name, anon_user): ``user{i}`` by first appearance; a null user counts."""
    first = facts.groupBy("user_name").agg(first_seen("_first" in facts.columns))
    index = dense_index(first, [F.col("_first").asc(), F.col("user_name").asc()], "_index")
    return index.select("user_name", F.concat(F.lit("user"), F.col("_index")).alias("anon_user"))


def split_by_user(software: Column, who: Column) -> Column:
    """Append the user to generic application labels; a null user gives NULL."""
    return F.when(software.isin(SPLIT_SOFTWARE), F.concat(software, F.lit("_"), who)).otherwise(software)


def exe_use(facts: DataFrame) -> DataFrame:
    """Use (an exact decimal) and rows by executable name, of facts or grouped facts."""
    if "_n" in facts.columns:
        use = F.coalesce(from_limbs(*(F.sum(f"_w{k}") for k in range(3))), F.lit(0).cast(EXACT_SUM))
        return facts.groupBy("exe_name").agg(use.alias("use_s"), F.sum("_n").alias("rows"))
    return facts.groupBy("exe_name").agg(exact_sum(F.col("use_s")).alias("use_s"), F.count("*").alias("rows"))


def significant_exes(by_exe: DataFrame, dictionary: Dictionary, cfg: UsageConfig) -> DataFrame:
    """Unidentified executables above the threshold share of all use.

    ``by_exe`` holds (exe_name, use_s, rows) and is read twice. Uses are not
    negative, so at most 1/threshold executables qualify.
    """
    use = F.col("use_s").cast("double")
    total = by_exe.agg(F.struct(F.sum("use_s").cast("double").alias("use_s"), F.sum("rows").alias("rows")).alias("t"))
    tagged = with_classes(by_exe, dictionary, cfg.family)
    unidentified = (F.col("software").isNull() if cfg.family == "energy"
                    else F.col("software") == UNKNOWN)
    return (tagged.filter(unidentified)
            .withColumn("_t", total.scalar())
            .filter((F.col("_t.rows") > 0) & (use >= F.col("_t.use_s") * cfg.unknown_thresh))
            .select("exe_name", use.alias("use_s"), "rows"))


def unidentified_report(facts: DataFrame, dictionary: Dictionary, cfg: UsageConfig) -> DataFrame:
    """Executable, use and count of significant unidentified executables."""
    return significant_exes(cut(exe_use(facts)), dictionary, cfg).select(
        F.col("exe_name").alias("ExeName"),
        (F.col("use_s") / cfg.use_divisor).alias("Nodeh" if cfg.family == "energy" else "Usage"),
        F.col("rows").alias("Count"),
    ).orderBy(F.desc("Nodeh" if cfg.family == "energy" else "Usage"), F.asc("ExeName"))
