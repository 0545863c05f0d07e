"""The fact table: steps, jobs without steps, users, GPUs, areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from jobuse.functions.scalars import gpu_count, step_order
from jobuse.operators.filters import gpu_rows
from jobuse.operators.hotkeys import HotKeys, join_split
from jobuse.sources.dumps import with_job_ids

# How a job without steps is tagged.
NO_STEP_EXE = "no_srun"
NO_STEP_ID = "0"

SPREAD = 1024     # groups that rows of one id are spread over by their contents


def tag_steps(steps: DataFrame) -> DataFrame:
    return steps.withColumn("src", F.lit(0))


def tag_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.withColumns({
        "exe_name": F.lit(NO_STEP_EXE), "sub_job_id": F.lit(NO_STEP_ID), "src": F.lit(1)})


def assemble_usage(steps: DataFrame, jobs: DataFrame, mode: str = "anti", hot: HotKeys | None = None) -> DataFrame:
    """Steps, plus the jobs that have none.

    ``mode='anti'`` does that literally. ``mode='keep_last'`` follows the rule
    "drop the last row of every repeated job id", which differs where the job row
    of a stepped job is itself missing. ``hot`` names the ids that very many job
    rows share (null above all), which the anti join then splits; under the other rule
    those that very many rows of either kind share.
    """
    tagged = tag_jobs(jobs)
    if mode == "keep_last":
        return drop_last_of_repeated(tag_steps(steps).unionByName(tagged), hot)
    if mode != "anti":
        raise ValueError(f"mode must be 'anti' or 'keep_last', not {mode!r}")
    # Steps stay where they are; only their distinct job ids are shuffled, so a
    # job with very many steps sends one id per task.
    stepped = steps.select("job_id").distinct()
    without = join_split(tagged, stepped, ["job_id"], hot or HotKeys("job_id", {}), "left_anti")
    return tag_steps(steps).unionByName(without.select(*tagged.columns))


def drop_last_of_repeated(rows: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Without the last row (by source, step number, then all columns) of each repeated job id.

    Whole rows are shuffled once, by job id and step, so the steps of a job are spread over
    tasks; rows without an id, and those of ids that ``hot`` names, are also spread by their
    contents. The last row of a group is found where the group lies, and only the place of
    a job's last group travels (with contents for rows spread by them).
    """
    rest = [c for c in rows.columns if c not in ("src", "job_id", "sub_job_id")]
    named = [k for k in hot.parts if k is not None] if hot else []
    spread = F.col("job_id").isNull() | (F.col("job_id").isin(named) if named else F.lit(False))
    part = F.when(spread, 1 + F.pmod(F.xxhash64(*rest), F.lit(SPREAD))).otherwise(0)
    # Keys that are never NULL, so that the shuffle serves the join too; _group tells what was.
    keys = ["_job", "_step", "_group"]
    grouped = rows.select(
        F.coalesce("job_id", F.lit(0).cast(rows.schema["job_id"].dataType)).alias("_job"),
        F.coalesce("sub_job_id", F.lit("")).alias("_step"),
        (part * 8 + F.col("src") * 4 + F.col("job_id").isNull().cast("int") * 2 + F.col("sub_job_id").isNull().cast("int")).alias("_group"),
        *rest).repartition(*keys)
    src = F.when(F.col("_group").bitwiseAND(4) == 0, F.lit(0)).otherwise(F.lit(1)).alias("src")
    job = F.when(F.col("_group").bitwiseAND(2) == 0, F.col("_job")).alias("job_id")
    step = F.when(F.col("_group").bitwiseAND(1) == 0, F.col("_step")).alias("sub_job_id")
    numbered = grouped.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in rest])))
    # Two rows of a group tell whether the id is repeated. (They need all columns, as the rows
    # themselves do: both then read the same shuffle.)
    place = F.struct(src, step_order(step).alias("step"), F.when(F.col("_group") >= 8, F.struct(*rest)).alias("rest"), "_group")
    last = numbered.filter("_rank <= 2").groupBy(job).agg(F.max(place).alias("last"), F.count("*").alias("n")).filter("n > 1")
    last = last.select(F.coalesce("job_id", F.lit(0).cast(rows.schema["job_id"].dataType)).alias("_job"),
                       F.coalesce("last.step.name", F.lit("")).alias("_step"), F.col("last._group").alias("_group"), F.lit(1).alias("_hit"))
    left = numbered.join(last, keys, "left").filter("_hit IS NULL OR _rank > 1")
    restored = {"src": src, "job_id": job, "sub_job_id": step}
    return left.select(*[restored.get(c, F.col(c)) for c in rows.columns])


def join_by_job(rows: DataFrame, values: DataFrame, column: str, hot: HotKeys | None = None) -> DataFrame:
    """Replace ``column`` by the value mapped to the row's job id (NULL if none).

    Both sides are as long as the job list, so this is a shuffled join; a job
    holding very many rows is split: beforehand where ``hot`` names it, otherwise
    by the adaptive skew join.
    """
    order = rows.columns if column in rows.columns else rows.columns + [column]
    return join_split(rows.drop(column), values, ["job_id"], hot or HotKeys("job_id", {})).select(*order)


def gpu_counts(allocations: DataFrame, jobs: bool = False) -> DataFrame:
    """(src, job_id, sub_job_id, ngpus) from GPU dumps of steps or of whole jobs."""
    return counted_gpus(allocated_gpus(allocations, jobs))


def allocated_gpus(allocations: DataFrame, jobs: bool = False) -> DataFrame:
    """GPUs of each entry of a dump, by source, job and step."""
    rows = with_job_ids(gpu_rows(allocations) if jobs else allocations)
    if jobs:
        rows = rows.withColumn("sub_job_id", F.lit(NO_STEP_ID))
    return rows.select(F.lit(int(jobs)).alias("src"), "job_id", "sub_job_id", gpu_count(F.col("allocation")).alias("ngpus"))


def counted_gpus(entries: DataFrame) -> DataFrame:
    """The greatest count of each step or job. (Dumps joined beforehand are shuffled once, for a join as well.)"""
    return entries.groupBy("src", "job_id", "sub_job_id").agg(F.max("ngpus").alias("ngpus"))


def join_gpu(rows: DataFrame, counts: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """GPU counts by job and step; steps and step-less jobs are kept apart by ``src``."""
    joined = join_split(rows.drop("ngpus"), counts, ["src", "job_id", "sub_job_id"], hot or HotKeys("job_id", {}))
    return joined.select(*[c for c in rows.columns if c != "ngpus"], "ngpus")
