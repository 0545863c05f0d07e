"""One query per operator and report, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog import fixtures as fx
from jobuse.config import UsageConfig
from jobuse.functions import scalars as s
from jobuse.operators import assemble, classify, filters, hotkeys, identity, joins, matrix, quality, rollup, stats, wordindex
from jobuse.plans import analyses as reports, periods, runs
from jobuse.plans.facts import energy_facts, numeric, usage_facts, with_use
from jobuse.session import cut, fit_reads, input_bytes, made_folder, shared_dir
from jobuse.sources import definitions, dumps, report as report_source, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

NODEH = UsageConfig(report_energy=True)
COREH = replace(NODEH, units="Coreh")
GPUH = replace(NODEH, gpu=True)
SHARED = replace(NODEH, shared_node=True)
ENERGY = UsageConfig(family="energy")
SPLIT = replace(NODEH, user_split=True)
ENERGY_SPLIT = replace(ENERGY, user_split=True)
PROJECT = "p3"      # of the reports on one project
# Dumps as text, compressed; a file is read by one task, so its rows are bounded.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1 << 19}

QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ---- shared inputs ----------------------------------------------------------------

def kept_steps(spark, d):
    return filters.kept_states(fx.steps(spark, d))


def kept_jobs(spark, d):
    return filters.kept_states(fx.jobs(spark, d))


def raw_usage(spark, d, mode="anti"):
    return assemble.assemble_usage(kept_steps(spark, d), kept_jobs(spark, d), mode)


def facts(spark, d, cfg=NODEH):
    return usage_facts(raw_usage(spark, d), cfg)


def first_step_exes(spark, d):
    """job id -> executable of its step 0."""
    first = fx.steps(spark, d).filter("sub_job_id = '0'")
    return first.groupBy("job_id").agg(F.max("exe_name").alias("exe_name"))


def raw_energy(spark, d):
    return assemble.join_by_job(kept_jobs(spark, d), first_step_exes(spark, d), "exe_name")


def job_energy_facts(spark, d, cfg=ENERGY):
    return energy_facts(raw_energy(spark, d), cfg)


def scratch(spark) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


# ---- scans and sinks: written by Spark from the tables, then read back ----------------

def _line(columns: list[str], sep: str) -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _dump(df: DataFrame, columns: list[str], sep: str, folder: str) -> str:
    df.select(_line(columns, sep)).write.text(folder)
    return folder


def _dumps(df: DataFrame, **layouts: tuple[list[str], str]) -> dict[str, str]:
    """Several compressed dumps of the same rows (columns and separator of each), which are made once."""
    fit_reads(df.sparkSession)
    folder = scratch(df.sparkSession)
    lines = [F.struct(F.lit(kind).alias("kind"), _line(columns, sep).alias("value")) for kind, (columns, sep) in layouts.items()]
    df.select(F.inline(F.array(*lines))).write.options(**COMPRESSED).partitionBy("kind").text(folder)
    return {kind: made_folder(df.sparkSession, f"{folder}/kind={kind}") for kind in layouts}


STEP_LAYOUT = dumps.STEP_COLUMNS, "::"
GPU_LAYOUT = ["job_id_raw", "state", "allocation"], ","


def _with_memory(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"max_rss": F.lit(None).cast("string"), "mean_rss": F.lit("0")})


def _step_dump(spark, rows: DataFrame) -> str:
    return _dump(_with_memory(rows), *STEP_LAYOUT, scratch(spark))


@query("scan_steps")
def _(spark, d):
    raw = fx.steps(spark, d).withColumn("job_id_raw", F.concat_ws(".", "job_id", "sub_job_id"))
    return dumps.with_job_ids(dumps.read_steps(spark, _step_dump(spark, raw))).drop("max_rss")


@query("scan_jobs")
def _(spark, d):
    raw = fx.jobs(spark, d).withColumn("job_id_raw", F.col("job_id"))
    return dumps.with_job_ids(dumps.read_jobs(spark, _step_dump(spark, raw))).drop("max_rss", "sub_job_id")


def _map_file(entries: DataFrame, columns: list[str], folder: str, header: bool) -> str:
    """Entries (``id``, ``k``, ``value``) in order of ``k``; a NULL value gives a row without one."""
    line = F.concat_ws(", ", F.col("id").cast("string"), "value")
    rows = entries.repartition("job_id").sortWithinPartitions("job_id", "id", "k", "value").select(line.alias(",".join(columns)))
    rows.write.option("header", header).option("sep", "\u0001").option("quote", "").csv(folder)
    return folder


@query("scan_user_map")
def _(spark, d):
    """Jobs with an earlier entry, with missing tokens, and with a row that ends after the id."""
    jobs = fx.jobs(spark, d).select("job_id", F.col("job_id").alias("id"), "user_name")
    user = (F.when(F.col("job_id") % 11 == 0, F.lit("None")).when(F.col("job_id") % 13 == 0, F.lit("nan"))
            .when(F.col("job_id") % 19 == 0, F.lit("")).otherwise(F.col("user_name")))
    entries = (jobs.filter("job_id % 4 = 0").select("job_id", "id", F.lit(0).alias("k"), F.lit("zz earlier").alias("value"))
               .unionByName(jobs.select("job_id", "id", F.lit(1).alias("k"), user.alias("value")))
               .unionByName(jobs.filter("job_id % 17 = 0").select("job_id", "id", F.lit(2).alias("k"), F.lit(None).cast("string").alias("value"))))
    return dumps.read_user_map(spark, _map_file(entries, ["job_id", "user_name"], scratch(spark), True))


def _allocations(rows: DataFrame) -> DataFrame:
    return rows.withColumn("allocation", F.format_string(
        "cpu=%d,gres/gpu=%d,mem=%dG,node=%d", "ntasks", "ngpus", F.col("nodes") * 256, "nodes"))


@query("scan_gpu_alloc")
def _(spark, d):
    rows = _allocations(fx.steps(spark, d)).withColumn(
        "job_id_raw", F.concat_ws(".", "job_id", "sub_job_id"))
    return dumps.read_gpu_alloc(
        spark, _dump(rows, ["job_id_raw", "state", "allocation"], ",", scratch(spark)))


def _merged(spark, d) -> DataFrame:
    rows = raw_usage(spark, d).withColumns(
        {"max_rss": F.lit("1M"), "mean_rss": F.lit(None).cast("string")})
    return rows.select(*dumps.USAGE_COLUMNS_GPU)


@query("scan_usage")
def _(spark, d):
    path = scratch(spark)
    sinks.write_merged(_merged(spark, d), path, "csv")
    return dumps.read_usage(spark, path, gpu=True).drop("mean_rss")


@query("sink_merged")
def _(spark, d):
    path = scratch(spark)
    sinks.write_merged(_merged(spark, d), path, partition_by=["state"])
    return spark.read.parquet(path).drop("mean_rss")


def bucketed(spark, d, buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps and jobs by month, and users, in tables of as many buckets of job ids; by default as many as the steps need."""
    if buckets is None:
        buckets = tables.bucket_count(input_bytes(spark, list(fx.table_paths(d, fx.FX_STEPS).values())))

    def table(rows, kind, time=None):
        name = f"{kind}_{uuid.uuid4().hex}"
        return tables.write_table(rows, name, f"{shared_dir(spark)}/{name}", buckets, time)

    users = fx.jobs(spark, d).filter("job_id % 13 <> 0").select("job_id", F.upper("user_name").alias("user_name"))
    return (table(filters.kept_states(fx.steps(spark, d, extra=True)), "steps", "started"),
            table(filters.kept_states(fx.jobs(spark, d, extra=True)), "jobs", "started"), table(users, "users"))


def colocated(steps: DataFrame, jobs: DataFrame, users: DataFrame) -> DataFrame:
    """Records of two years and a few days from bucketed tables."""
    import datetime as dt
    return runs.records_of_tables(steps, jobs, users, "started", dt.datetime(1996, 1, 10), dt.datetime(1998, 2, 3)).select(*ASSEMBLED)


@query("colocated_records")
def _(spark, d):
    return colocated(*bucketed(spark, d))


@query("usage_records")
def _(spark, d):
    """The whole way from dump files: steps with batch entries, jobs, users, GPUs."""
    tail = F.when(F.col("sub_job_id") == "5", "batch").otherwise(F.col("sub_job_id"))
    step_rows = _allocations(fx.steps(spark, d)).withColumn("job_id_raw", F.concat_ws(".", "job_id", tail))
    job_rows = _allocations(fx.jobs(spark, d)).withColumn("job_id_raw", F.col("job_id"))
    users = fx.jobs(spark, d).select("job_id", "user_name")
    step_dumps, job_dumps = (_dumps(_with_memory(rows).withColumn("user_name", F.lit("")), entries=STEP_LAYOUT, gpu=GPU_LAYOUT)
                             for rows in (step_rows, job_rows))
    return runs.usage_records(
        dumps.read_steps(spark, step_dumps["entries"]), dumps.read_jobs(spark, job_dumps["entries"]),
        dumps.read_user_map(spark, _csv(users, scratch(spark))), NODEH,
        dumps.read_gpu_alloc(spark, step_dumps["gpu"]), dumps.read_gpu_alloc(spark, job_dumps["gpu"]),
    ).select("job_id", "sub_job_id", "exe_name", "user_name", "account", "nodes", "runtime", "ngpus")


def _csv(rows: DataFrame, folder: str) -> str:
    fit_reads(rows.sparkSession)
    rows.write.options(**COMPRESSED).option("header", True).csv(folder)
    return folder


@query("energy_records")
def _(spark, d):
    """The whole way from dump files: jobs, and step names from which step 0 is taken."""
    job_rows = fx.jobs(spark, d).withColumn("job_id_raw", F.col("job_id"))
    jobs = dumps.read_energy_jobs(spark, _dump(job_rows, dumps.ENERGY_COLUMNS, "::", scratch(spark)))
    path = _map_file(_step_entries(spark, d), ["job_id", "exe_name"], scratch(spark), False)
    return runs.energy_records(jobs, dumps.read_step_exe_rows(spark, path), ENERGY).select(
        "job_id", "exe_name", "user_name", "nodes", "runtime", "energy_j")


@query("scan_energy_jobs")
def _(spark, d):
    raw = fx.jobs(spark, d).withColumn("job_id_raw", F.col("job_id"))
    return dumps.read_energy_jobs(spark, _dump(raw, dumps.ENERGY_COLUMNS, "::", scratch(spark)))


def _step_entries(spark, d) -> DataFrame:
    """Steps by job and step id; some first steps have an earlier entry of another name."""
    steps = fx.steps(spark, d).select("job_id", F.concat_ws(".", "job_id", "sub_job_id").alias("id"), "sub_job_id", "exe_name")
    return (steps.filter("sub_job_id = '0' AND job_id % 4 = 0")
            .select("job_id", "id", F.lit(0).alias("k"), F.lit("zz_earlier").alias("value"))
            .unionByName(steps.select("job_id", "id", F.lit(1).alias("k"), F.col("exe_name").alias("value"))))


@query("scan_step_exe")
def _(spark, d):
    entries = _step_entries(spark, d).filter("id LIKE '%.0'").withColumn(
        "value", F.when((F.col("job_id") % 11 == 0) & (F.col("k") == 1), F.lit("None")).otherwise(F.col("value")))
    return dumps.read_step_exe(spark, _map_file(entries, ["job_id", "exe_name"], scratch(spark), False))


@query("scan_code_defs")
def _(spark, d):
    """One definition file per distinct part name."""
    path = scratch(spark)
    parts = fx.view(spark, d, "SELECT * FROM {part}").groupBy(
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("exe")).agg(
        F.min("p_type").alias("type"), F.min("p_brand").alias("brand"))
    text = F.concat_ws(
        "\n", F.lit("# generated\n[code info]"), F.concat(F.lit("name: "), "exe"),
        F.concat(F.lit("regexp: ^"), "exe", F.lit("$")), F.lit("\n[metadata]"),
        F.concat(F.lit("primary language:  "), "brand"), F.lit("version:          95"),
        F.lit("academic license = Free"), F.lit("commercial license = Fee"),
        F.concat(F.lit("code type: "), "type"), F.lit("research area: "), F.lit("parallel-model: MPI"))
    parts.select("exe", text.alias("value")).repartition("exe").write.partitionBy("exe").text(path)
    return definitions.read_code_defs(spark, path, glob="*.txt")


@query("scan_areas")
def _(spark, d):
    path = scratch(spark)
    fx.all_areas(spark, d).select("project_id", F.concat(F.lit(" "), "area").alias("area")).write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return dumps.read_areas(spark, path)


def _period_summaries(spark, d) -> DataFrame:
    """Energy by project and order year, with an Overall row per year."""
    rows = fx.jobs(spark, d, extra=True).withColumn("period", F.year("started"))
    rows = filters.kept_states(rows)
    base = energy_facts(rows.drop("started", "partition_name", "period"), ENERGY)
    timed = base.join(rows.select("job_id", "period"), "job_id")
    sums = [(F.coalesce(F.sum("energy_j"), F.lit(0.0)) / s.JOULES_PER_KWH).alias("kWh"),
            (F.sum("use_s") / ENERGY.use_divisor).alias("Nodeh"),
            F.count_distinct("user_name").alias("Users"),
            F.count_distinct("project_id").alias("Projects")]
    return timed.groupBy("period", F.col("project_id").alias("key")).agg(*sums).unionByName(
        timed.groupBy("period").agg(*sums).withColumn("key", F.lit("Overall")))


@query("scan_summaries")
def _(spark, d):
    """One folder a period; odd ones order their columns otherwise and have one more."""
    path, table = scratch(spark), _period_summaries(spark, d)
    even = table.filter("period % 2 = 0").select("period", "key", "kWh", "Nodeh", "Users", "Projects")
    odd = table.filter("period % 2 = 1").select("period", "Projects", F.lit("x").alias("Remark"), "Nodeh", "key", "Users", "kWh")
    for part in (even, odd):
        part.repartition("period").write.mode("append").partitionBy("period").option("header", True).csv(path)
    return dumps.read_summaries(spark, f"{path}/*", "")


@query("combine_summaries")
def _(spark, d):
    """The combined table, written and read back."""
    path = f"{scratch(spark)}/combined"
    sinks.write_combined(rollup.combine_summaries(_period_summaries(spark, d)), path)
    return spark.read.schema("key string, kWh double, Nodeh double, Users_min bigint, Users_max bigint, Projects_min bigint, "
                             "Projects_max bigint, PercentEnergy double, PercentUse double").csv(path, header=True)


def _report_path(spark, d) -> str:
    """Scheduling reports as text files, one per order priority."""
    sizes = F.array(*[F.lit(x) for x in fx.SCHED_SIZES])
    cells = fx.sched(spark, d)
    line = F.concat_ws(
        ",", F.get(sizes, F.col("slot").cast("int")), F.col("submitted"), F.col("ran"),
        F.col("usage_s") / 3600, F.lit("x"), F.concat(F.col("slot"), F.lit(":00:00")),
        F.col("ran") / F.col("submitted"))
    entries = F.array_sort(F.collect_list(F.struct("slot", line.alias("line"))))     # 15 at most
    blocks = cells.groupBy("report", "block").agg(entries.alias("e")).select(
        "report", "block", F.concat_ws(
            "\n", F.concat(F.lit("Runtime: "), F.col("block") + 1, F.lit("h")),
            F.lit("Nodes,Submitted,Ran,Usage,-,Wait,Coefficient"), F.col("e.line"), F.lit(",total")
        ).alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "text")))                # 6 blocks
    empty = f"Runtime: {fx.SCHED_EMPTY_BLOCK + 1}h\nNodes,Submitted,Ran,Usage,-,Wait,Coefficient\n,total"
    path = scratch(spark)
    blocks.groupBy("report").agg(ordered.alias("b")).select(
        "report", F.concat_ws("\n", F.lit("scheduling report"), F.col("b.text"), F.lit(empty)),
    ).repartition("report").write.partitionBy("report").text(path)
    return path


def _report_rows(spark, d) -> DataFrame:
    return report_source.read_report(spark, _report_path(spark, d))


def _report_grid(spark, d) -> DataFrame:
    path = _report_path(spark, d)
    return matrix.dense(report_source.read_report(spark, path), report_source.report_blocks(spark, path))


def _report_id() -> object:
    return F.regexp_extract("file_path", r"report=(\d+)", 1).cast("int").alias("report")


@query("sched_report_rows")
def _(spark, d):
    rows = _report_rows(spark, d)
    return rows.select(_report_id(), *[c for c in rows.columns if c not in ("file_path", "line")])


@query("sched_matrix_dense")
def _(spark, d):
    cells = _report_grid(spark, d)
    return cells.select(_report_id(), *[c for c in cells.columns if c != "file_path"])


@query("sched_matrix_hot")
def _(spark, d):
    cells = matrix.hot(_report_grid(spark, d))
    return cells.select(_report_id(), "block", "size", "usage", "ran", "hot")


@query("sched_matrix_pivot")
def _(spark, d):
    table = matrix.pivoted(_report_grid(spark, d).filter(F.col("size").isin(report_source.SIZES)), "coefficient")
    return table.select(_report_id(), "block", "runtime", *[f"`{x}`" for x in report_source.SIZES])


@query("sink_result")
def _(spark, d):
    table = reports.report(facts(spark, d), "CodeSize", NODEH, dictionary=fx.dictionary())
    path = sinks.write_result(table, scratch(spark), "use", "CodeSize")
    return spark.read.csv(path, header=True, schema=dumps.text_schema(table.columns))


@query("empty_guard")
def _(spark, d):
    """Totals where there is something to analyse; no row for an unknown project."""
    some, none = facts(spark, d), facts(spark, d, replace(NODEH, account="no-such-project"))
    parts = [quality.totals(f, NODEH) if sinks.has_rows(f) else
             quality.totals(f, NODEH).limit(0) for f in (some, none)]
    return parts[0].unionByName(parts[1])


# ---- cleaning and row selection ------------------------------------------------------

def _lineitem(spark, d):
    return fx.view(spark, d, "SELECT * FROM {lineitem}")


@query("na_normalise")
def _(spark, d):
    token = F.element_at(F.array(*[F.lit(t) for t in [*s.NA_TOKENS, "na", "none"]]),
                         (F.col("p_partkey") % 21 + 1).cast("int"))
    parts = fx.view(spark, d, "SELECT * FROM {part}")
    return s.normalise_na(parts.select(
        "p_partkey", token.alias("token"), F.when(F.col("p_size") > 10, F.col("p_name"))
        .otherwise("None").alias("exe_name")))


NUMBER_SAMPLES = ["1e5", " 12 ", "12K", "1.5d", "1f", "NaN", "", "1,000", "0x10", "-3.25", "+7.", ".5",
                  "18446744073709551614"]


@query("coerce_numeric")
def _(spark, d):
    k = F.col("l_partkey") % (len(NUMBER_SAMPLES) + 3)
    text = F.when(k < len(NUMBER_SAMPLES), F.get(
        F.array(*[F.lit(x) for x in NUMBER_SAMPLES]), k.cast("int"))).otherwise(F.col("l_partkey").cast("string"))
    rows = _lineitem(spark, d).select("l_orderkey", "l_linenumber", text.alias("text"))
    return rows.select("l_orderkey", "l_linenumber", s.to_number(F.col("text")).alias("value"))


def _raw_ids(spark, d):
    """Step ids as dumped, with batch and extern entries among them."""
    tail = F.when(F.col("sub_job_id") == "6", "batch").when(
        F.col("sub_job_id") == "5", "extern").otherwise(F.col("sub_job_id"))
    return fx.steps(spark, d).select(
        F.concat_ws(".", "job_id", tail).alias("job_id_raw"), "exe_name", "state")


@query("filter_real_steps")
def _(spark, d):
    return filters.real_steps(_raw_ids(spark, d))


@query("filter_first_step")
def _(spark, d):
    return filters.first_steps(_raw_ids(spark, d))


@query("split_job_id")
def _(spark, d):
    return dumps.with_job_ids(_raw_ids(spark, d))


@query("filter_states")
def _(spark, d):
    return kept_steps(spark, d).groupBy("state").agg(F.count("*").alias("rows")).unionByName(
        filters.kept_states(fx.jobs(spark, d), replace(NODEH, exclude_states="COMPLETED|FAILED"))
        .groupBy("state").agg(F.count("*").alias("rows")))


@query("filter_time")
def _(spark, d):
    import datetime as dt
    rows = filters.in_period(_lineitem(spark, d), "l_shipdate", dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1))
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate")


@query("filter_attrs")
def _(spark, d):
    rows = filters.with_attributes(fx.jobs(spark, d, extra=True), partition_name=filters.ENERGY_PARTITIONS,
                                   cpu_freq="1-URGENT")
    return rows.select("job_id", "user_name", "partition_name", "cpu_freq")


@query("filter_project")
def _(spark, d):
    return facts(spark, d, replace(NODEH, account="p7")).select(
        "job_id", "sub_job_id", "user_name", "project_id", "group_id", "use_s")


@query("filter_dropna")
def _(spark, d):
    return facts(spark, d, replace(NODEH, drop_nan=True)).select("job_id", "sub_job_id", "energy_j", "use_s")


@query("exe_missing_policy")
def _(spark, d):
    """Jobs without a first step: dropped in usage reports, 'Unknown' in energy reports."""
    raw = raw_energy(spark, d)
    one = usage_facts(raw, NODEH).groupBy("exe_name").agg(F.count("*").alias("rows"))
    two = energy_facts(raw, ENERGY).groupBy("exe_name").agg(F.count("*").alias("rows"))
    return one.withColumn("family", F.lit("usage")).unionByName(two.withColumn("family", F.lit("energy")))


def _numeric_steps(spark, d):
    return numeric(fx.steps(spark, d))


ID = ["job_id", "sub_job_id"]


@query("clean_energy")
def _(spark, d):
    return _numeric_steps(spark, d).select(*ID, s.plausible_energy(F.col("energy_j"), NODEH).alias("energy_j"))


@query("clean_power")
def _(spark, d):
    return facts(spark, d).select(*ID, "node_power")


@query("node_power")
def _(spark, d):
    power = s.mean_node_power(F.col("energy_j"), F.col("runtime"), F.col("nodes"))
    return _numeric_steps(spark, d).select(*ID, power.alias("node_power"))


@query("energy_kwh")
def _(spark, d):
    return _numeric_steps(spark, d).select(*ID, s.kwh(F.col("energy_j")).alias("energy_kwh"))


@query("cores_smt_cap")
def _(spark, d):
    return _numeric_steps(spark, d).select(
        *ID, s.used_cores(F.col("ntasks"), F.col("nodes"), NODEH).alias("cores"))


@query("clamp_usage")
def _(spark, d):
    """Corrections booked as negative runtimes."""
    rows = fx.steps(spark, d).withColumn(
        "runtime", F.when(F.col("job_id") % 11 == 0, -F.col("runtime")).otherwise(F.col("runtime")))
    return with_use(usage_facts(rows, NODEH), NODEH).select(*ID, "use")


def _use_query(cfg):
    return lambda spark, d: with_use(facts(spark, d, cfg), cfg).select(*ID, "use")


QUERIES["usage_nodeh"] = _use_query(SHARED)
QUERIES["usage_coreh"] = _use_query(COREH)
QUERIES["usage_gpuh"] = _use_query(replace(GPUH, shared_node=True))
QUERIES["usage_gpu_subnode"] = _use_query(GPUH)
QUERIES["usage_coreh_reference"] = _use_query(replace(COREH, coreh_subnode="reference"))


@query("usage_subnode")
def _(spark, d):
    return with_use(facts(spark, d), NODEH).select(*ID, "cores", "use", "energy_kwh", "node_power")


@query("filter_full_node")
def _(spark, d):
    return facts(spark, d).filter(filters.is_full_node(NODEH)).select(*ID, "cores", "node_power")


@query("split_account")
def _(spark, d):
    account = F.col("account")
    return fx.jobs(spark, d).select("job_id", s.project_of(account).alias("project_id"),
                                    s.group_of(account).alias("group_id"))


def _job_allocations(spark, d):
    """Whole-job allocations; some name no GPU, some are missing."""
    rows = _allocations(fx.jobs(spark, d)).withColumn("allocation", F.when(
        F.col("job_id") % 5 == 0, F.format_string("billing=%d,cpu=%d", "ntasks", "ntasks")).when(
        F.col("job_id") % 7 != 0, F.concat(F.lit("billing=1,"), "allocation")))
    return rows.select(F.col("job_id").cast("string").alias("job_id_raw"), "state", "allocation")


@query("gpu_rows")
def _(spark, d):
    return filters.gpu_rows(_job_allocations(spark, d))


@query("parse_gpu_count")
def _(spark, d):
    return _job_allocations(spark, d).select(
        "job_id_raw", s.gpu_count(F.col("allocation")).alias("ngpus"))


# ---- assembly and joins ------------------------------------------------------------------

ASSEMBLED = ["job_id", "sub_job_id", "exe_name", "user_name", "account", "nodes", "ntasks", "runtime",
             "state", "energy_j", "cpu_freq", "ngpus"]


@query("assemble_usage")
def _(spark, d):
    return raw_usage(spark, d).select(*ASSEMBLED)


@query("assemble_usage_keep_last")
def _(spark, d):
    """Step ids run to 12, so their order by number is not that by text."""
    steps = kept_steps(spark, d).withColumn("sub_job_id", (F.col("sub_job_id").cast("int") * 2).cast("string"))
    return assemble.assemble_usage(steps, kept_jobs(spark, d), "keep_last").select(*ASSEMBLED)


@query("join_user")
def _(spark, d):
    """Users from the job list replace those of the assembled rows; some jobs have none."""
    users = fx.jobs(spark, d).filter("job_id % 13 <> 0").select("job_id", F.upper("user_name").alias("user_name"))
    return assemble.join_by_job(raw_usage(spark, d), users, "user_name").select(*ID, "user_name", "exe_name")


@query("join_user_hot")
def _(spark, d):
    """Nine rows in ten lie on one job, and one in twenty on none; both are split before the join."""
    rows = raw_usage(spark, d)
    turn = F.col("runtime") % 20
    rows = rows.withColumn("job_id", F.when(turn == 0, F.lit(None)).when(turn == 1, F.col("job_id")).otherwise(fx.HOT_JOB))
    users = fx.jobs(spark, d).filter("job_id % 13 <> 0").select("job_id", F.upper("user_name").alias("user_name"))
    hot = hotkeys.hot_keys(rows)
    return assemble.join_by_job(rows, users, "user_name", hot).select("job_id", "sub_job_id", "user_name", "exe_name", "runtime")


@query("join_step_exe")
def _(spark, d):
    return raw_energy(spark, d).select("job_id", "exe_name", "account", "nodes", "runtime")


@query("join_gpu")
def _(spark, d):
    step_rows = _allocations(fx.steps(spark, d)).select(
        F.concat_ws(".", "job_id", "sub_job_id").alias("job_id_raw"), "state", "allocation")
    counts = assemble.gpu_counts(step_rows).unionByName(
        assemble.gpu_counts(_job_allocations(spark, d), jobs=True))
    return assemble.join_gpu(raw_usage(spark, d).drop("ngpus"), counts).select(*ID, "exe_name", "ngpus")


@query("join_area")
def _(spark, d):
    return joins.lookup(facts(spark, d), fx.areas(spark, d), "project_id").select(
        *ID, "project_id", "area")


@query("classify_exe")
def _(spark, d):
    return classify.with_classes(facts(spark, d), fx.dictionary()).select(
        *ID, "exe_name", "software", "motif", "language")


@query("classify_by_words")
def _(spark, d):
    """A dictionary that grows with the tables: tied, wild and optional words, groups, and every customer."""
    rows = fx.steps(spark, d).withColumn("exe_name", F.expr(fx.FX_LONG_NAME))
    return wordindex.with_classes_by_words(rows, fx.view(spark, d, fx.FX_DEFS)).select(*ID, "exe_name", "software", "motif", "language")


def _classified(spark, d):
    return classify.with_classes(
        facts(spark, d).groupBy("exe_name").agg(F.count("*").alias("rows")), fx.dictionary())


@query("motif_tokens")
def _(spark, d):
    return classify.distinct_tokens(_classified(spark, d), "motif", "token")


@query("lang_tokens")
def _(spark, d):
    return classify.distinct_tokens(_classified(spark, d), "language", "token")


@query("anon_users")
def _(spark, d):
    return identity.anonymous_users(facts(spark, d))


@query("user_split")
def _(spark, d):
    """Rows per application label, generic applications split by anonymous user."""
    base = facts(spark, d)
    by = base.groupBy("exe_name", "user_name").agg(F.count("*").alias("rows"), F.sum("use_s").alias("use_s"))
    users = identity.anonymous_users(base)
    tagged = classify.with_classes(by, fx.dictionary()).join(
        users.withColumnRenamed("user_name", "_u"), F.col("user_name").eqNullSafe(F.col("_u")), "left")
    label = identity.split_by_user(F.col("software"), F.col("anon_user"))
    return tagged.groupBy(label.alias("software")).agg(
        F.sum("rows").alias("rows"), F.sum("use_s").alias("use_s"))


@query("user_split_unidentified")
def _(spark, d):
    return reports.report(facts(spark, d), "CodeSize", SPLIT, dictionary=fx.dictionary())


@query("user_split_named")
def _(spark, d):
    """With the users' own names."""
    cfg = replace(SPLIT, anonymise=False)
    return reports.report(facts(spark, d), "CodeSize", cfg, dictionary=fx.dictionary())


@query("energy_code_size_split")
def _(spark, d):
    return reports.report(job_energy_facts(spark, d), "CodeSize", ENERGY_SPLIT, dictionary=fx.dictionary())


@query("energy_code_power_split")
def _(spark, d):
    return reports.report(job_energy_facts(spark, d), "CodePower", ENERGY_SPLIT, dictionary=fx.dictionary())


def _project_report(spark, d, name, cfg):
    """On one project: users are numbered and motif words taken over all projects, shares are of the project."""
    raw, cfg = raw_usage(spark, d), replace(cfg, account=PROJECT)
    return reports.report(usage_facts(raw, cfg), name, cfg, dictionary=fx.dictionary(),
                          all_facts=usage_facts(raw, cfg, for_account=False))


@query("project_motif_size")
def _(spark, d):
    return _project_report(spark, d, "MotifSize", NODEH)


@query("project_code_size_split")
def _(spark, d):
    return _project_report(spark, d, "CodeSize", SPLIT)


@query("unidentified_exes")
def _(spark, d):
    return identity.unidentified_report(facts(spark, d), fx.dictionary(), NODEH)


@query("energy_unidentified_exes")
def _(spark, d):
    return identity.unidentified_report(job_energy_facts(spark, d), fx.dictionary(), ENERGY)


# ---- aggregates ------------------------------------------------------------------------

def _dist(spark, d, name, cfg=NODEH):
    base = job_energy_facts(spark, d, cfg) if cfg.family == "energy" else facts(spark, d, cfg)
    analysis = reports.analyses_of(cfg)[name]
    return reports.distribution_of(base, analysis, cfg, dictionary=fx.dictionary(), areas=fx.areas(spark, d))


@query("overall_stats")
def _(spark, d):
    return _dist(spark, d, "ProjSize").select(
        "label", "use", "percent_use", "kwh", "percent_energy", "jobs", "users", "projects")


@query("dist_unweighted")
def _(spark, d):
    return _dist(spark, d, "ProjSize").select("label", "min", "q1", F.col("q2").alias("median"), "q3", "max")


@query("dist_weighted")
def _(spark, d):
    return _dist(spark, d, "ProjSize").select(
        "label", F.col("wq1").alias("q1"), F.col("wq2").alias("median"), F.col("wq3").alias("q3"))


@query("totals")
def _(spark, d):
    return quality.totals(facts(spark, d), NODEH)


@query("quality_energy")
def _(spark, d):
    return quality.energy_quality(facts(spark, d), NODEH)


@query("quality_energy_jobs")
def _(spark, d):
    return quality.energy_quality(job_energy_facts(spark, d), ENERGY)


@query("quality_node_power")
def _(spark, d):
    return quality.node_power_quality(facts(spark, d), NODEH)


@query("distinct_values")
def _(spark, d):
    return quality.distinct_values(facts(spark, d), ["project_id", "user_name", "cpu_freq"])


@query("running_usage")
def _(spark, d):
    """Running use by size within each application."""
    sizes = cut(reports.code_sizes(facts(spark, d), NODEH, fx.dictionary()))
    return stats.running(sizes, "value", ["software"], n="copies", w="use_s").select(
        "software", "value", (F.col("cw").cast("double") / NODEH.use_divisor).alias("running_use"),
        (F.col("tw").cast("double") / NODEH.use_divisor).alias("total_use"))


@query("top_codes")
def _(spark, d):
    sizes = reports.code_sizes(facts(spark, d), NODEH, fx.dictionary())
    return reports.top_codes(sizes).select(
        "software", (F.col("use_s") / NODEH.use_divisor).alias("use"))


@query("top_code_boxstats")
def _(spark, d):
    return reports.top_code_boxes(facts(spark, d), NODEH, fx.dictionary())


@query("code_use_ranking")
def _(spark, d):
    return reports.code_use_ranking(facts(spark, d), NODEH, fx.dictionary())


@query("weighted_expand")
def _(spark, d):
    return reports.repeated_rows(facts(spark, d), NODEH).select(*ID, "cores", "copy")


@query("report_projection")
def _(spark, d):
    """The table as printed when energy is not asked for."""
    return reports.report(facts(spark, d), "ProjSize", replace(NODEH, report_energy=False))


@query("energy_report_projection")
def _(spark, d):
    """The energy table for the web: shares only."""
    cfg = replace(ENERGY, web=True)
    return reports.report(job_energy_facts(spark, d, cfg), "AreaSize", cfg, areas=fx.areas(spark, d))


# ---- named reports -----------------------------------------------------------------------

def _report_query(name: str, cfg: UsageConfig, weighted: bool) -> Query:
    def run(spark, d):
        base = job_energy_facts(spark, d, cfg) if cfg.family == "energy" else facts(spark, d, cfg)
        return reports.report(base, name, cfg, weighted, dictionary=fx.dictionary(), areas=fx.areas(spark, d))
    return run


# query name -> (report, parameters)
REPORTS: dict[str, tuple[str, UsageConfig]] = {
    "dist_code_size": ("CodeSize", NODEH),
    "dist_code_power": ("CodePower", NODEH),
    "dist_area_size": ("AreaSize", NODEH),
    "dist_project_size": ("ProjSize", NODEH),
    "dist_area_power": ("AreaPower", NODEH),
    "dist_motif_size": ("MotifSize", NODEH),
    "dist_motif_power": ("MotifPower", NODEH),
    "dist_lang_size": ("LangSize", NODEH),
    "dist_lang_power": ("LangPower", NODEH),
    "dist_cpufreq_size": ("CPUFreqSize", NODEH),
    "dist_cpufreq_power": ("CPUFreqPower", NODEH),
    "dist_code_size_coreh": ("CodeSize", COREH),
    "dist_code_size_shared": ("CodeSize", SHARED),
    "dist_code_size_gpu": ("CodeSize", GPUH),
    "dist_area_size_gpu": ("AreaSize", GPUH),
    "dist_project_size_gpu": ("ProjSize", GPUH),
    "dist_motif_size_gpu": ("MotifSize", GPUH),
    "dist_lang_size_gpu": ("LangSize", GPUH),
    "dist_cpufreq_size_gpu": ("CPUFreqSize", GPUH),
    "dist_code_power_gpu": ("CodePower", GPUH),
    "dist_area_power_gpu": ("AreaPower", GPUH),
    "dist_motif_power_gpu": ("MotifPower", GPUH),
    "dist_lang_power_gpu": ("LangPower", GPUH),
    "dist_cpufreq_power_gpu": ("CPUFreqPower", GPUH),
    "energy_code_size": ("CodeSize", ENERGY),
    "energy_code_power": ("CodePower", ENERGY),
    "energy_area_size": ("AreaSize", ENERGY),
    "energy_area_power": ("AreaPower", ENERGY),
    "energy_motif_size": ("MotifSize", ENERGY),
    "energy_motif_power": ("MotifPower", ENERGY),
}
for _name, (_report, _cfg) in REPORTS.items():
    QUERIES[_name] = _report_query(_report, _cfg, False)
    QUERIES[f"{_name}_weighted"] = _report_query(_report, _cfg, True)


# ---- periods, and quartiles from one pass ---------------------------------------------------

def _over_periods(spark, d, name: str, cfg: UsageConfig, power: bool = False) -> DataFrame:
    """Jobs dealt to four periods, each stored grouped; then the report over all four."""
    folder = scratch(spark)
    base = job_energy_facts(spark, d, cfg) if cfg.family == "energy" else facts(spark, d, cfg)
    periods.write_periods(base, F.concat(F.lit("q"), F.col("job_id") % 4), cfg, folder, power)
    return periods.reports_over(spark, folder, [name], cfg, [f"q{k}" for k in range(4)], dictionary=fx.dictionary())[name]


@query("periods_code_size")
def _(spark, d):
    return _over_periods(spark, d, "CodeSize", NODEH)


@query("periods_energy_code_power")
def _(spark, d):
    return _over_periods(spark, d, "CodePower", ENERGY, power=True)


@query("periods_user_split")
def _(spark, d):
    """Users are numbered by their first appearance in any period."""
    return _over_periods(spark, d, "CodeSize", SPLIT)


@query("approx_code_power")
def _(spark, d):
    """By application: whether each approximate quartile of node power is within its bound of the exact one."""
    approx = reports._measure(reports.USAGE_ANALYSES["CodePower"], replace(NODEH, approx=True))
    near, exact = (_dist(spark, d, "CodePower", replace(NODEH, approx=a)) for a in (True, False))
    quartiles = ["q1", "q2", "q3", "wq1", "wq2", "wq3"]
    both = near.select("label", "jobs", *quartiles).join(exact.select("label", *[F.col(c).alias(f"exact_{c}") for c in quartiles]), "label", "full")
    return both.select(F.col("label").alias("Software"), F.col("jobs").alias("Jobs"), *[
        F.coalesce(F.abs(F.col(c) - F.col(f"exact_{c}")) <= approx.error, F.col(c).isNull() & F.col(f"exact_{c}").isNull()).alias(f"{c}_near")
        for c in quartiles])
