"""Job-accounting views over the given tables, in SQL both engines run.

``{name}`` stands for a base table: a parquet path in Spark, a view in the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobuse.session import fit_shuffles, input_bytes
from jobuse.sources.definitions import Dictionary
from jobuse.sources.report import SIZES

# Columns of the given tables; a declared schema spares reading footers up front.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

# (name, pattern, motif, language), in order of precedence
CODES = [
    ("Gear", "gear", "GridA GridB", "Fortran"),
    ("Widget", "widget", "GridA", "C++"),
    ("Python", "plate", "", "Python"),
    ("a.out", "rod", "Unknown", "Unknown"),
    ("Anvil", "anvil|bolt", "Grid", "C"),
    ("RedFamily", "^red_", "Particle", "Fortran"),
]

FX_CODES = "SELECT * FROM (VALUES " + ", ".join(
    "(%d,'%s','%s','%s','%s')" % (i, *row) for i, row in enumerate(CODES)
) + ") AS t(ord, software, pattern, motif, lang)"

FX_JOBS = """
SELECT o.o_orderkey AS job_id, '0' AS sub_job_id, 'no_srun' AS exe_name, c.c_name AS user_name,
 concat('p', c.c_nationkey, '-', lower(c.c_mktsegment)) AS account,
 1 + o.o_orderkey % 4 AS nodes, 128*(1 + o.o_orderkey % 4) AS ntasks,
 CAST(floor(o.o_totalprice/10) AS BIGINT) AS runtime,
 CASE WHEN o.o_orderkey % 50 = 0 THEN 'PENDING' ELSE 'COMPLETED' END AS state,
 CASE WHEN o.o_orderkey % 10 = 3 THEN NULL
      WHEN o.o_orderkey % 97 = 0 THEN CAST(20000000000000000 AS BIGINT)
      ELSE CAST(floor(o.o_totalprice/10) AS BIGINT)*(1 + o.o_orderkey % 4)*(200 + o.o_orderkey % 700) END AS energy_j,
 o.o_orderpriority AS cpu_freq, o.o_orderkey % 9 AS ngpus, o.o_orderdate AS started,
 CASE WHEN o.o_custkey % 3 = 0 THEN 'highmem' WHEN o.o_custkey % 3 = 1 THEN 'standard' ELSE 'serial' END AS partition_name
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

FX_STEPS = """
SELECT l.l_orderkey AS job_id, CAST(l.l_linenumber - 1 AS VARCHAR(9)) AS sub_job_id,
 replace(p.p_name,' ','_') AS exe_name, c.c_name AS user_name,
 concat('p', c.c_nationkey, '-', lower(c.c_mktsegment)) AS account,
 1 + l.l_suppkey % 4 AS nodes, CAST(l.l_quantity AS BIGINT)*16 AS ntasks,
 CAST(floor(l.l_extendedprice/10) AS BIGINT) AS runtime,
 CASE WHEN l.l_linenumber = 7 THEN 'RUNNING' WHEN l.l_linenumber = 6 THEN 'FAILED' ELSE 'COMPLETED' END AS state,
 CASE WHEN l.l_partkey % 10 = 3 THEN NULL
      WHEN l.l_partkey % 97 = 0 THEN CAST(20000000000000000 AS BIGINT)
      ELSE CAST(floor(l.l_extendedprice/10) AS BIGINT)*(1 + l.l_suppkey % 4)*(200 + l.l_partkey % 700) END AS energy_j,
 o.o_orderpriority AS cpu_freq, l.l_orderkey % 9 AS ngpus, l.l_shipdate AS started,
 CASE WHEN o.o_custkey % 3 = 0 THEN 'highmem' WHEN o.o_custkey % 3 = 1 THEN 'standard' ELSE 'serial' END AS partition_name
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
 JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# Names with a step's number and, in places, its user.
FX_LONG_NAME = "concat(exe_name, '_', job_id % 10, CASE WHEN job_id % 4 = 0 THEN concat('/', user_name) ELSE '' END)"

# A dictionary as long as the customer list: words, tied, wild and optional words, groups.
FX_DEFS = """
SELECT ord, name, pattern, 'GridA' AS motif, CASE WHEN ord % 2 = 0 THEN 'C' END AS language FROM (
 SELECT 3 * k AS ord, concat('A ', p) AS name, concat('^', p, '_', k % 10) AS pattern FROM
  (SELECT replace(p_name, ' ', '_') AS p, min(p_partkey) AS k FROM {part} GROUP BY p_name) a
 UNION ALL SELECT 3 * k + 1, concat('B ', p), concat(substr(p, 1, 3), '.*', right(p, 3), '_7$') FROM
  (SELECT replace(p_name, ' ', '_') AS p, min(p_partkey) AS k FROM {part} WHERE p_size < 9 GROUP BY p_name) b
 UNION ALL SELECT 3 * k + 2, concat('C ', p), concat(p, '_5/|', p, 'x?_9') FROM
  (SELECT replace(p_name, ' ', '_') AS p, min(p_partkey) AS k FROM {part} WHERE p_size > 40 GROUP BY p_name) c
 UNION ALL SELECT 1000000000 + CAST(r_regionkey AS BIGINT), r_name, concat('^(red|small)_.*_', r_regionkey, '$') FROM {region}
 UNION ALL SELECT 2000000000 + c_custkey, concat('user ', c_custkey), c_name FROM {customer}) x
"""

FX_ALL_AREAS = """
SELECT concat('p', n.n_nationkey) AS project_id, r.r_name AS area
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# For joins: projects of two nations have no area.
FX_AREAS = f"SELECT * FROM ({FX_ALL_AREAS}) a WHERE project_id NOT IN ('p11', 'p23')"

# Scheduling report cells: five reports, six runtime classes with rows, fifteen sizes (the last is not listed).
FX_SCHED = """
SELECT CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS report, o.o_custkey % 6 AS block, o.o_orderkey % 15 AS slot,
 count(*) AS submitted,
 count(CASE WHEN (o.o_custkey % 6 + o.o_orderkey % 15) % 5 <> 0 THEN 1 END) AS ran,
 CAST(sum(CAST(floor(o.o_totalprice/10) AS BIGINT)) AS BIGINT) AS usage_s
FROM {orders} o
GROUP BY CAST(substr(o.o_orderpriority, 1, 1) AS INT), o.o_custkey % 6, o.o_orderkey % 15
"""
SCHED_SIZES = [*SIZES, "8193-16384"]
HOT_JOB = 7                # the job that most rows of a skewed table lie on
SCHED_EMPTY_BLOCK = 6      # a runtime class without rows


def dictionary() -> Dictionary:
    return Dictionary.of(*CODES)


def oracle_text(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **tables_of(spark, sf_dir, sql))


def tables_of(spark: SparkSession, sf_dir: str, sql: str) -> dict[str, DataFrame]:
    """The tables that a view reads."""
    paths = table_paths(sf_dir, sql)
    fit_shuffles(spark, input_bytes(spark, list(paths.values())))
    return {t: spark.read.schema(TABLES[t]).parquet(path) for t, path in paths.items()}


def step_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``FX_STEPS``: its columns, over its joins in another order.

    Lines are joined in the order of the SQL to orders, customers and parts, so they are shuffled three
    times, and twice with the columns of the tables before. Here they are shuffled twice: by part, and by order,
    to orders that have their customers.
    """
    columns = FX_STEPS.split("\nFROM ")[0]
    named = {t[0]: df for t, df in tables_of(spark, sf_dir, FX_STEPS).items()}
    placed = named["o"].join(named["c"], F.expr("o_custkey = c_custkey"))
    rows = named["l"].join(named["p"], F.expr("l_partkey = p_partkey")).join(placed, F.expr("l_orderkey = o_orderkey"))
    return spark.sql(columns + "\nFROM {rows}", rows=rows.select(*[F.struct(*df.columns).alias(t) for t, df in named.items()]))


def table_paths(sf_dir: str, sql: str) -> dict[str, str]:
    """The files of the tables that a view reads."""
    return {t: f"{sf_dir}/{t}.parquet" for t in TABLES if "{%s}" % t in sql}


_EXTRA = ["started", "partition_name"]


def steps(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    df = step_view(spark, sf_dir)
    return df if extra else df.drop(*_EXTRA)


def jobs(spark: SparkSession, sf_dir: str, extra: bool = False) -> DataFrame:
    df = view(spark, sf_dir, FX_JOBS)
    return df if extra else df.drop(*_EXTRA)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FX_AREAS)


def all_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FX_ALL_AREAS)


def sched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FX_SCHED)
