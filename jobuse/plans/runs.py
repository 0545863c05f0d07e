"""Whole runs: from dumps to records, and from facts to a set of written reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from jobuse.config import UsageConfig
from jobuse.functions.scalars import job_id_of
from jobuse.operators.assemble import allocated_gpus, assemble_usage, counted_gpus, join_by_job, join_gpu, tag_jobs, tag_steps
from jobuse.operators.filters import first_steps, kept_states, of_project, real_steps
from jobuse.operators.hotkeys import hot_keys
from jobuse.operators.identity import anonymous_users, unidentified_report
from jobuse.operators.quality import energy_quality, node_power_quality
from jobuse.plans.analyses import analyses_of, distributions_of, report_table
from jobuse.plans.facts import facts_of
from jobuse.session import stored
from jobuse.sources.dumps import with_job_ids
from jobuse.sources.sinks import has_rows, write_result
from jobuse.sources.tables import rows_between


def usage_records(steps: DataFrame, jobs: DataFrame, users: DataFrame, cfg: UsageConfig,
                  gpu_steps: DataFrame | None = None, gpu_jobs: DataFrame | None = None,
                  mode: str = "anti", split_hot: bool = False) -> DataFrame:
    """Step-level records from step, job and user dumps (and GPU dumps).

    ``split_hot`` looks for job ids that hold a large part of the steps or of the jobs (one more pass
    over their ids) and splits them in every join; without it that is left to the adaptive skew join.
    """
    step_rows = with_job_ids(kept_states(real_steps(steps), cfg))
    job_rows = with_job_ids(kept_states(jobs, cfg)).drop("sub_job_id")
    hot_jobs = hot_keys(job_rows) if split_hot else None
    hot = hot_keys(step_rows.select("job_id").unionByName(job_rows.select("job_id"))) if split_hot else None
    rows = join_by_job(assemble_usage(step_rows, job_rows, mode, hot_jobs if mode == "anti" else hot), users, "user_name", hot)
    if gpu_steps is None:
        return rows
    entries = allocated_gpus(real_steps(gpu_steps))
    if gpu_jobs is not None:
        entries = entries.unionByName(allocated_gpus(gpu_jobs, jobs=True))
    return join_gpu(rows, counted_gpus(entries), hot)


def records_of_tables(steps: DataFrame, jobs: DataFrame, users: DataFrame, time: str = "started",
                      start=None, end=None) -> DataFrame:
    """Step-level records of a range of time, from tables bucketed by job id (``write_table``).

    Users are joined to steps and to jobs apart: a union forgets how its rows lie.
    With as many buckets in all three tables nothing is shuffled.
    """
    step_rows, job_rows = (rows_between(t, time, start, end) for t in (steps, jobs))
    stepped = step_rows.select("job_id").distinct()
    without = tag_jobs(job_rows).join(stepped, "job_id", "left_anti")
    return join_by_job(tag_steps(step_rows), users, "user_name").unionByName(join_by_job(without, users, "user_name"))


def energy_records(jobs: DataFrame, step_exes: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Job-level records, named by the executable of each job's first step.

    ``step_exes`` is either a job -> executable map or raw (job.step, executable,
    position) rows, of which the last by position counts.
    """
    if "job_id_raw" in step_exes.columns:
        step_exes = first_steps(step_exes).groupBy(job_id_of(F.col("job_id_raw")).alias("job_id")).agg(
            F.max_by("exe_name", "position").alias("exe_name"))
    return join_by_job(kept_states(jobs, cfg), step_exes, "exe_name")


def write_reports(records: DataFrame, names: Iterable[str], cfg: UsageConfig, folder: str,
                  prefix: str, **inputs) -> dict[str, str]:
    """Write both tables of each named report; returns their paths.

    Facts are derived once and stored while the reports are made. One cube of cells
    serves all reports: the facts are read once for it, and once more for the
    quartiles of node power. The statistics of a report are computed once for its two tables. Every run also writes the significant unidentified executables
    (with a dictionary) and the data-quality table. Nothing is written without
    records.
    """
    paths = {}
    with stored(facts_of(records, cfg, for_account=False)) as everyone:
        facts = of_project(everyone, cfg.account)
        if not has_rows(facts):
            return paths
        if cfg.user_split and cfg.anonymise and "users" not in inputs:
            inputs["users"] = anonymous_users(everyone)
        if cfg.account:
            inputs["all_facts"] = everyone
        asked = [analyses_of(cfg)[name] for name in names]
        for analysis, both in zip(asked, distributions_of(facts, asked, cfg, is_stored=True, **inputs)):
            name = analysis.name
            for weighted in (False, True):
                table = report_table(both, analysis, cfg, weighted)
                key = f"{name}{'_weighted' if weighted else ''}"
                paths[key] = write_result(table, folder, prefix, name, weighted)
        dictionary = inputs.get("dictionary")
        if dictionary:
            paths["Unidentified"] = write_result(unidentified_report(facts, dictionary, cfg), folder, prefix, "Unidentified")
        quality = energy_quality(facts, cfg) if cfg.family == "energy" else node_power_quality(facts, cfg)
        paths["Quality"] = write_result(quality, folder, prefix, "Quality")
    return paths
