"""From raw records to the fact frame reports are made of.

The order of the steps matters: power is taken before energy is prorated, rows
are dropped for missing values before executables are, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.config import UsageConfig
from jobuse.functions import scalars as s
from jobuse.operators.filters import complete_rows, of_project

NUMERIC = ["nodes", "ntasks", "runtime", "energy_j", "ngpus"]


def numeric(raw: DataFrame) -> DataFrame:
    """Lenient conversion of the numeric columns that are present."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.withColumns({
        c: s.to_number(F.col(c), types[c]) for c in NUMERIC if c in types})


def _shared(df: DataFrame) -> dict[str, Column]:
    columns = {"src": F.col("src") if "src" in df.columns else F.lit(0),
               "sub_job_id": F.col("sub_job_id") if "sub_job_id" in df.columns else F.lit("0")}
    return columns | {c: F.col(c) for c in ("job_id", "exe_name", "user_name")} | {
        "project_id": s.project_of(F.col("account")), "group_id": s.group_of(F.col("account"))}


def _present(df: DataFrame, names: list[str]) -> dict[str, Column]:
    return {n: F.col(n) for n in names if n in df.columns}


def usage_facts(raw: DataFrame, cfg: UsageConfig, for_account: bool = True) -> DataFrame:
    """Step-level facts: size, use, prorated energy and node power of each row."""
    df = numeric(raw).withColumn("energy_j", s.plausible_energy(F.col("energy_j"), cfg))
    if cfg.drop_nan:
        df = complete_rows(df, [c for c in raw.columns if c != "src"])
    nodes, runtime, energy = F.col("nodes"), F.col("runtime"), F.col("energy_j")
    df = df.filter(F.col("exe_name").isNotNull()).withColumns({
        "cores": s.used_cores(F.col("ntasks"), nodes, cfg),
        "node_power": s.mean_node_power(energy, runtime, nodes)})
    cores = F.col("cores")
    ngpus = F.col("ngpus") if "ngpus" in df.columns else F.lit(None).cast("double")
    # Each measure is a column of its own before it is cleaned, not a repeated expression.
    df = df.withColumns({
        "ngpus": ngpus, "use_s": s.unit_seconds(nodes, cores, ngpus, runtime, cfg),
        "energy_j": s.prorate(energy, cores, cfg),
        "node_power": s.prorate(F.col("node_power"), cores, cfg)})
    facts = df.select(*[c.alias(n) for n, c in _shared(df).items()], *_present(df, ["cpu_freq"]).values(),
                      s.finite(nodes).alias("nodes"), s.finite(cores).alias("cores"),
                      s.finite(F.col("ngpus")).alias("ngpus"), s.finite(runtime).alias("runtime"),
                      s.finite(s.clamp(F.col("use_s"))).alias("use_s"),
                      s.finite(F.col("energy_j")).alias("energy_j"),
                      s.plausible_power(F.col("node_power"), cfg).alias("node_power"))
    return of_project(facts, cfg.account) if for_account else facts


def energy_facts(raw: DataFrame, cfg: UsageConfig, for_account: bool = True) -> DataFrame:
    """Job-level facts: node-hours, energy and node power of each whole job."""
    df = numeric(raw).withColumn("energy_j", s.plausible_energy(F.col("energy_j"), cfg))
    if cfg.drop_nan:
        df = complete_rows(df, [c for c in raw.columns if c != "src"])
    nodes, runtime, energy = F.col("nodes"), F.col("runtime"), F.col("energy_j")
    null = F.lit(None).cast("double")
    df = df.withColumns({
        "use_s": s.unit_seconds(nodes, null, null, runtime, cfg),
        "node_power": s.mean_node_power(energy, runtime, nodes)})
    shared = _shared(df) | {"exe_name": F.coalesce(F.col("exe_name"), F.lit("Unknown"))}
    facts = df.select(*[c.alias(n) for n, c in shared.items()],
                      s.finite(nodes).alias("nodes"), s.finite(runtime).alias("runtime"),
                      s.finite(F.col("use_s")).alias("use_s"),
                      s.finite(energy).alias("energy_j"),
                      s.plausible_power(F.col("node_power"), cfg).alias("node_power"))
    return of_project(facts, cfg.account) if for_account else facts


def facts_of(raw: DataFrame, cfg: UsageConfig, for_account: bool = True) -> DataFrame:
    make = energy_facts if cfg.family == "energy" else usage_facts
    return make(raw, cfg, for_account)


def with_use(facts: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Use in reported hours and energy in kWh beside the exact sums' units."""
    return facts.withColumns({
        "use": F.col("use_s") / cfg.use_divisor, "energy_kwh": s.kwh(F.col("energy_j"))})
