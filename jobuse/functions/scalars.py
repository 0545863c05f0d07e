"""Column expressions: cleaning, parsing and per-row measures.

Everything here is a built-in expression, so it stays inside generated code.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobuse.config import UsageConfig

# The texts a CSV reader of the pandas family takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What counts as a number. Spark's own cast also takes Java suffixes (1f, 1.5d).
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

JOULES_PER_KWH = 3.6e6


def normalise_na(df: DataFrame) -> DataFrame:
    """Missing tokens to NULL on every string column, in one projection."""
    return df.select([
        F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def to_number(col: Column, dtype: T.DataType | None = None) -> Column:
    """Lenient conversion to double; anything that is not a number gives NULL."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col.cast("double"))
    if dtype is not None and not isinstance(dtype, T.StringType):
        return col.cast("double")
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def finite(col: Column) -> Column:
    """+inf to NULL (-inf is kept)."""
    return F.when(col != F.lit(float("inf")), col)


# ---- exact sums -------------------------------------------------------------

# Use is whole unit-seconds and energy 1/128 J where it is prorated, so seven
# digits hold both, and sums do not depend on how rows are spread.
EXACT_SUM = "decimal(38,7)"

# A measure is added up as three whole numbers, which stay in primitive fields of
# the aggregation buffer: multiples of 2**23, the rest below that, and the
# fraction in units of 10**-7. Each sum has room for some 10**11 rows.
LIMB = 1 << 23
UNITS = 10 ** 7
LARGEST = 1e21      # what is beyond is missing, as is infinity


def limbs(value: Column) -> tuple[Column, Column, Column]:
    """The three parts of a measure; every step is exact in a double."""
    value = F.when(F.abs(value) < LARGEST, value)
    high = F.floor(value / LIMB)
    rest = value - high.cast("double") * LIMB
    whole = F.floor(rest)
    return high, whole, F.round((rest - whole.cast("double")) * UNITS).cast("bigint")


def from_limbs(high: Column, whole: Column, units: Column) -> Column:
    """The decimal that three sums of parts stand for; NULL of nothing."""
    def d(c: Column) -> Column:
        return c.cast("decimal(20,0)")
    return (d(high) * F.lit(Decimal(LIMB)) + d(whole) + d(units) * F.lit(Decimal(1) / UNITS)).cast(EXACT_SUM)


def added(value: Column) -> Column:
    """The exact sum of a measure, NULL of nothing."""
    return from_limbs(*(F.sum(part) for part in limbs(value)))


def exact_sum(value: Column) -> Column:
    """The exact sum of a measure, zero of nothing."""
    return F.coalesce(added(value), F.lit(0).cast(EXACT_SUM))


# ---- identifiers ------------------------------------------------------------

def job_id_of(raw: Column) -> Column:
    return F.split(raw, r"\.", 2).getItem(0).try_cast("bigint")


def sub_job_id_of(raw: Column) -> Column:
    return F.get(F.split(raw, r"\.", 2), F.lit(1))


def step_order(sub_job_id: Column) -> Column:
    """Sorts step ids by number; those that are none (``batch``) come first, by name."""
    return F.struct(sub_job_id.try_cast("bigint").alias("number"), sub_job_id.alias("name"))


def project_of(account: Column) -> Column:
    return F.split(account, "-", 2).getItem(0)


def group_of(account: Column) -> Column:
    return F.get(F.split(account, "-", 2), F.lit(1))


def gpu_count(allocation: Column) -> Column:
    """GPUs named in an allocation string such as ``cpu=8,gres/gpu=2,mem=1G``."""
    text = F.regexp_extract(allocation, r"(?:^|,)gres/gpu=([^,]*)", 1)
    return to_number(F.when(text != "", text))


# ---- measures ---------------------------------------------------------------

def plausible_energy(energy_j: Column, cfg: UsageConfig) -> Column:
    return F.when(energy_j <= cfg.max_energy_j, energy_j)


def plausible_power(power: Column, cfg: UsageConfig) -> Column:
    return F.when(power <= cfg.max_power, power)


def mean_node_power(energy_j: Column, runtime: Column, nodes: Column) -> Column:
    return F.try_divide(energy_j, runtime * nodes)


def power_is_missing(energy_j: Column, runtime: Column, nodes: Column) -> Column:
    """Missing in the IEEE sense: an operand is missing, or 0/0. (x/0 is infinite.)"""
    return (energy_j.isNull() | runtime.isNull() | nodes.isNull()
            | ((runtime * nodes == 0) & (energy_j == 0)))


def kwh(energy_j: Column) -> Column:
    return energy_j / F.lit(JOULES_PER_KWH)


def used_cores(ntasks: Column, nodes: Column, cfg: UsageConfig) -> Column:
    """Tasks, capped at the physical cores where SMT packs more tasks on a node."""
    smt = (F.try_divide(ntasks, nodes) > cfg.cpn) | ((nodes == 0) & (ntasks > 0))
    return F.when(smt, nodes * cfg.cpn).otherwise(ntasks)


def unit_seconds(nodes: Column, cores: Column, ngpus: Column, runtime: Column,
                 cfg: UsageConfig) -> Column:
    """Use of a row in unit-seconds; ``cfg.use_divisor`` turns it into hours."""
    if cfg.family == "energy":
        return nodes * runtime
    if cfg.gpu:
        size, part = ngpus, cfg.gpn
        whole = ngpus
    elif cfg.units == "Coreh":
        if cfg.shared_node or cfg.coreh_subnode == "fixed":
            return cores * runtime
        size, part, whole = cores, cfg.cpn, cores
    else:
        size, part, whole = cores, cfg.cpn, nodes
    if cfg.shared_node:
        return whole * runtime
    return F.when(size < part, size * runtime).otherwise(whole * runtime * part)


def clamp(use: Column) -> Column:
    """Negative use to 0; missing stays missing."""
    return F.when(use < 0, F.lit(0.0)).otherwise(use)


def prorate(value: Column, cores: Column, cfg: UsageConfig) -> Column:
    """Share of a node-level reading that belongs to a row below one node."""
    if cfg.shared_node:
        return value
    return F.when(cores < cfg.cpn, cores * value / F.lit(float(cfg.cpn))).otherwise(value)
