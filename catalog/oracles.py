"""The same results in plain SQL, row by row and without the cell machinery."""

from __future__ import annotations

from catalog import fixtures as fx
from catalog.queries import NUMBER_SAMPLES, PROJECT, REPORTS
from jobuse.config import UsageConfig
from jobuse.functions.scalars import NA_TOKENS
from jobuse.sources.report import SIZES

FX = fx.oracle_text(f"""fx_codes AS ({fx.FX_CODES}), fx_jobs AS ({fx.FX_JOBS}),
fx_steps AS ({fx.FX_STEPS}), fx_all_areas AS ({fx.FX_ALL_AREAS}), fx_areas AS ({fx.FX_AREAS}), fx_sched AS ({fx.FX_SCHED})""")

BAD = "('RUNNING', 'PENDING', 'REQUEUED')"

COLS = ("job_id, sub_job_id, exe_name, user_name, account, nodes, ntasks, runtime, state, energy_j, "
        "cpu_freq, ngpus")

RAW = f"""{FX},
s AS (SELECT {COLS}, 0 AS src FROM fx_steps WHERE state NOT IN {BAD}),
j AS (SELECT {COLS}, 1 AS src FROM fx_jobs WHERE state NOT IN {BAD}),
u AS (SELECT * FROM s UNION ALL SELECT * FROM j
      WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.job_id = j.job_id))"""

FIRST = """first_exe AS (SELECT job_id, max(exe_name) AS exe FROM fx_steps WHERE sub_job_id = '0' GROUP BY job_id),
ej AS (SELECT j.* REPLACE (f.exe AS exe_name) FROM j LEFT JOIN first_exe f ON j.job_id = f.job_id)"""

CLASSES = """m AS (SELECT e.exe_name AS m_exe, max(c.ord) AS m_ord FROM (SELECT DISTINCT exe_name FROM f) e
      JOIN fx_codes c ON regexp_matches(e.exe_name, c.pattern) GROUP BY e.exe_name),
d AS (SELECT f.*, c.software AS code, coalesce(c.software, 'Unknown') AS software,
        coalesce(c.motif, 'Unknown') AS motif, coalesce(c.lang, 'Unknown') AS language, a.area
      FROM f LEFT JOIN m ON f.exe_name = m.m_exe LEFT JOIN fx_codes c ON m.m_ord = c.ord
      LEFT JOIN fx_areas a ON a.project_id = f.project_id)"""


def use_sql(cfg: UsageConfig) -> str:
    if cfg.gpu:
        if cfg.shared_node:
            return "CAST(ngpus * runtime AS DOUBLE)"
        return "CAST(CASE WHEN ngpus < 4 THEN ngpus * runtime ELSE ngpus * runtime * 4 END AS DOUBLE)"
    if cfg.units == "Coreh":
        if cfg.coreh_subnode == "reference":
            return "CAST(CASE WHEN cores < 128 THEN cores * runtime ELSE cores * runtime * 128 END AS DOUBLE)"
        return "CAST(cores * runtime AS DOUBLE)"
    if cfg.shared_node:
        return "CAST(nodes * runtime AS DOUBLE)"
    return "CAST(CASE WHEN cores < 128 THEN cores * runtime ELSE nodes * runtime * 128 END AS DOUBLE)"


def usage_facts(cfg: UsageConfig, rows: str = "u") -> str:
    part = "FALSE" if cfg.shared_node else "cores < 128"
    where = "WHERE energy_j IS NOT NULL" if cfg.drop_nan else ""
    return f"""c0 AS (SELECT *, CASE WHEN ntasks > 128 * nodes THEN 128 * nodes ELSE ntasks END AS cores,
        CAST(CASE WHEN energy_j <= 10000000000000000 THEN energy_j END AS DOUBLE) AS e0 FROM {rows}),
p0 AS (SELECT *, e0 / nullif(CAST(runtime * nodes AS DOUBLE), 0) AS p1 FROM c0),
p2 AS (SELECT * REPLACE (CASE WHEN {part} THEN CAST(cores AS DOUBLE) * p1 / 128.0 ELSE p1 END AS p1) FROM p0),
f AS (SELECT src, job_id, sub_job_id, exe_name, user_name, split_part(account, '-', 1) AS project_id, cpu_freq,
        CAST(nodes AS DOUBLE) AS nodes, CAST(cores AS DOUBLE) AS cores, CAST(ngpus AS DOUBLE) AS ngpus, runtime,
        {use_sql(cfg)} AS use_s,
        CASE WHEN {part} THEN CAST(cores AS DOUBLE) * e0 / 128.0 ELSE e0 END AS energy,
        CASE WHEN p1 <= 850 THEN p1 END AS node_power
      FROM (SELECT * REPLACE (e0 AS energy_j) FROM p2) z {where})"""


ENERGY_FACTS = """p0 AS (SELECT * , CAST(CASE WHEN energy_j <= 10000000000000000 THEN energy_j END AS DOUBLE) AS e0 FROM ej),
p2 AS (SELECT *, e0 / nullif(CAST(runtime * nodes AS DOUBLE), 0) AS p1 FROM p0),
f AS (SELECT src, job_id, sub_job_id, coalesce(exe_name, 'Unknown') AS exe_name, user_name,
        split_part(account, '-', 1) AS project_id, CAST(nodes AS DOUBLE) AS nodes,
        CAST(nodes * runtime AS DOUBLE) AS use_s, e0 AS energy,
        CASE WHEN p1 <= 850 THEN p1 END AS node_power FROM p2)"""


def facts_ctes(cfg: UsageConfig) -> str:
    if cfg.family == "energy":
        return f"{RAW}, {FIRST}, {ENERGY_FACTS}, {CLASSES}"
    return f"{RAW}, {usage_facts(cfg)}, {CLASSES}"


NODEH = UsageConfig(report_energy=True)
ENERGY = UsageConfig(family="energy")
FACTS = facts_ctes(NODEH)
ENERGY_ALL = facts_ctes(ENERGY)

# category -> (label column or token list, equality?)
_TOKENS = {
    "Motif": ("motif", "SELECT DISTINCT unnest(string_split(motif, ' ')) AS token FROM d"),
    "Software": ("code", "SELECT DISTINCT code AS token FROM d"),
    "Area": ("area", "SELECT DISTINCT area AS token FROM fx_areas"),
}
_EQUAL = {"Software": "software", "Area": "area", "ProjectID": "project_id", "Language": "language",
          "CPUFreq": "cpu_freq"}


def labelled(category: str, match: str, keep: str, unidentified: bool = False) -> str:
    """CTEs x (rows kept) and l (label, row), with Overall."""
    if match == "substring":
        column, tokens = _TOKENS[category]
        rows = (f"SELECT t.token AS label, x.* FROM x JOIN ({tokens}) t ON t.token IS NOT NULL "
                f"AND t.token <> '' AND contains(x.{column}, t.token)")
    else:
        rows = f"SELECT {_EQUAL[category]} AS label, x.* FROM x WHERE {_EQUAL[category]} IS NOT NULL"
    extra = "UNION ALL SELECT 'Unidentified' AS label, x.* FROM x WHERE code IS NULL" if unidentified else ""
    return f"""x AS (SELECT * FROM d WHERE {keep}),
l AS ({rows} {extra} UNION ALL SELECT 'Overall' AS label, x.* FROM x)"""


def stats_ctes(value: str, divisor: float) -> str:
    return f"""t AS (SELECT sum(use_s) AS w, sum(energy) AS e FROM d),
q AS (SELECT label, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2,
        quantile_cont({value}, 0.75) AS q3 FROM l GROUP BY label),
k AS (SELECT label, {value} AS v, sum(use_s) OVER (PARTITION BY label ORDER BY {value} ASC NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw, sum(use_s) OVER (PARTITION BY label) AS tw FROM l),
wq AS (SELECT label, min(CASE WHEN 4*cw >= tw THEN v END) AS wq1, min(CASE WHEN 4*cw >= 2*tw THEN v END) AS wq2,
         min(CASE WHEN 4*cw >= 3*tw THEN v END) AS wq3 FROM k GROUP BY label),
g AS (SELECT label, min({value}) AS mn, max({value}) AS mx, count(*) AS jobs, coalesce(sum(use_s), 0) AS w,
        coalesce(sum(energy), 0) AS e, count(DISTINCT user_name) AS users, count(DISTINCT project_id) AS projects
      FROM l GROUP BY label),
r AS (SELECT g.label, mn, mx, q1, q2, q3, wq1, wq2, wq3, jobs, g.w / {divisor} AS use, g.w * 100 / t.w AS percent_use,
        g.e / 3600000.0 AS kwh, g.e * 100 / t.e AS percent_energy, users, projects
      FROM g JOIN q USING (label) JOIN wq USING (label) CROSS JOIN t)"""


def report_sql(name: str, cfg: UsageConfig, weighted: bool, energy_columns: bool = True,
               use_columns: bool = True, absolute_energy: bool = True) -> str:
    category = {"Code": "Software", "Area": "Area", "Proj": "ProjectID", "Moti": "Motif", "Lang": "Language",
                "CPUF": "CPUFreq"}[name[:4]]
    power = name.endswith("Power")
    if power:
        value = "node_power"
    else:
        value = {"GPUh": "ngpus"}.get(cfg.unit_name, "cores") if cfg.family == "usage" else "nodes"
    energy = cfg.family == "energy"
    match = "substring" if energy or category == "Motif" else "equality"
    keep = "TRUE"
    if power and not energy:
        keep = "ngpus >= 4" if cfg.gpu else "cores >= 128"
    body = ", ".join([facts_ctes(cfg), labelled(category, match, keep, energy and category == "Software"),
                      stats_ctes(value, cfg.use_divisor)])
    q = ("wq1", "wq2", "wq3") if weighted else ("q1", "q2", "q3")
    columns = [f'label AS "{category}"', 'mn AS "Min"', f'{q[0]} AS "Q1"', f'{q[1]} AS "Median"',
               f'{q[2]} AS "Q3"', 'mx AS "Max"', 'jobs AS "Jobs"']
    if use_columns:
        columns.append(f'use AS "{cfg.unit_name}"')
    columns.append('percent_use AS "PercentUse"')
    if energy_columns:
        columns += ['kwh AS "kWh"'] * absolute_energy + ['percent_energy AS "PercentEnergy"']
    columns += ['users AS "Users"', 'projects AS "Projects"']
    return f"WITH {body} SELECT {', '.join(columns)} FROM r"


def q(body: str, select: str) -> str:
    return f"WITH {body} {select}"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ORACLES: dict[str, str] = {}

for _name, (_report, _cfg) in REPORTS.items():
    ORACLES[_name] = report_sql(_report, _cfg, False)
    ORACLES[f"{_name}_weighted"] = report_sql(_report, _cfg, True)

_STR = ("exe_name, user_name, account, CAST(nodes AS VARCHAR) AS nodes, CAST(ntasks AS VARCHAR) AS ntasks, "
        "CAST(runtime AS VARCHAR) AS runtime, state, CAST(energy_j AS VARCHAR) AS energy_j")
_CELLS = """cells AS (SELECT report, block, slot, CAST(submitted AS BIGINT) AS submitted, CAST(ran AS BIGINT) AS ran,
  CAST(usage_s AS DOUBLE) / 3600 AS usage, concat(slot, ':00:00') AS wait,
  CAST(ran AS DOUBLE) / submitted AS coefficient FROM fx_sched)"""
_SIZES = "sizes AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{s}')" for i, s in enumerate(fx.SCHED_SIZES)) + ") AS t(size_index, size))"
_GRID = f"""{FX}, {_CELLS}, {_SIZES}, blocks AS (SELECT DISTINCT report, block FROM cells
  UNION ALL SELECT DISTINCT report, {fx.SCHED_EMPTY_BLOCK} AS block FROM cells),
grid AS (SELECT b.report, b.block, concat(b.block + 1, 'h') AS runtime, z.size_index, z.size,
  coalesce(c.submitted, 0) AS submitted, coalesce(c.ran, 0) AS ran,
  CASE WHEN c.ran > 0 THEN c.usage END AS usage, coalesce(c.wait, '0:0:0') AS wait,
  CASE WHEN c.ran > 0 THEN c.coefficient END AS coefficient
  FROM blocks b CROSS JOIN sizes z LEFT JOIN cells c ON c.report = b.report AND c.block = b.block AND c.slot = z.size_index)"""
_RAW_IDS = """ids AS (SELECT concat(job_id, '.', CASE sub_job_id WHEN '6' THEN 'batch' WHEN '5' THEN 'extern'
  ELSE sub_job_id END) AS job_id_raw, exe_name, state FROM fx_steps)"""
_JOB_ALLOC = """alloc AS (SELECT CAST(job_id AS VARCHAR) AS job_id_raw, state, CASE
  WHEN job_id % 5 = 0 THEN concat('billing=', ntasks, ',cpu=', ntasks)
  WHEN job_id % 7 <> 0 THEN concat('billing=1,cpu=', ntasks, ',gres/gpu=', ngpus, ',mem=', nodes * 256, 'G,node=', nodes)
  END AS allocation, ngpus FROM fx_jobs)"""
_PERIODS = f"""{RAW}, pj AS (SELECT CAST(year(started) AS INT) AS period, split_part(account, '-', 1) AS project_id, user_name,
  CAST(nodes * runtime AS DOUBLE) AS use_s,
  CAST(CASE WHEN energy_j <= 10000000000000000 THEN energy_j END AS DOUBLE) AS e
  FROM fx_jobs WHERE state NOT IN {BAD}),
pl AS (SELECT period, project_id AS key, * EXCLUDE (period) FROM pj UNION ALL SELECT period, 'Overall' AS key, * EXCLUDE (period) FROM pj),
ps AS (SELECT period, key, coalesce(sum(e), 0) / 3600000.0 AS kwh, sum(use_s) / 3600.0 AS nodeh,
  count(DISTINCT user_name) AS users, count(DISTINCT project_id) AS projects FROM pl GROUP BY period, key)"""

_SIZED = """cs AS (SELECT software, cores AS value, sum(use_s) AS use_s,
  CAST(sum(floor(use_s / 460800.0)) AS BIGINT) AS copies FROM d GROUP BY software, cores)"""

_FIRST_SEEN = """seen AS (SELECT user_name, min(src * 1000000000000 + job_id * 10 + CAST(sub_job_id AS BIGINT)) AS pos
  FROM f GROUP BY user_name),
anon AS (SELECT user_name, concat('user', row_number() OVER (ORDER BY pos, user_name) - 1) AS anon_user FROM seen)"""

_TOTAL = "tot AS (SELECT sum(use_s) AS w FROM d)"
_BIG = f"""{_TOTAL}, big AS (SELECT exe_name, sum(use_s) AS w, count(*) AS n FROM d WHERE code IS NULL
  GROUP BY exe_name HAVING sum(use_s) >= 0.01 * (SELECT w FROM tot))"""

_SPAN = "started >= TIMESTAMP '1996-01-10' AND started < TIMESTAMP '1998-02-03'"

_REPORT_COLUMNS = (
    'SELECT label AS "Software", mn AS "Min", q1 AS "Q1", q2 AS "Median", q3 AS "Q3", mx AS "Max", jobs AS "Jobs", use AS "Nodeh", '
    'percent_use AS "PercentUse", kwh AS "kWh", percent_energy AS "PercentEnergy", users AS "Users", projects AS "Projects" FROM r')


def _split_labels(rows: str) -> str:
    """CTEs x and l: application labels split by ``who``."""
    return f"""x AS ({rows}),
 l AS (SELECT CASE WHEN b.exe_name IS NOT NULL THEN concat(x.exe_name, '_', who)
   WHEN software IN ('a.out', 'Python') THEN concat(software, '_', who) ELSE software END AS label, x.*
   FROM x LEFT JOIN big b ON b.exe_name = x.exe_name UNION ALL SELECT 'Overall' AS label, x.* FROM x)"""


def _of_project(ctes: str) -> str:
    return ctes.replace("FROM d)", "FROM d0)").replace("FROM d WHERE", "FROM d0 WHERE")


_ENERGY_SPLIT = """y AS (SELECT d.*, b.exe_name AS big_exe, CASE WHEN b.exe_name IS NOT NULL THEN concat(d.exe_name, '_', anon_user)
   WHEN code IN ('a.out', 'Python') THEN concat(code, '_', anon_user) ELSE code END AS split
   FROM d JOIN anon USING (user_name) LEFT JOIN big b ON b.exe_name = d.exe_name),
 l AS (SELECT t.split AS label, y.* FROM y JOIN (SELECT DISTINCT split FROM y WHERE split <> '') t ON contains(y.split, t.split)
   WHERE code IS NOT NULL OR big_exe IS NOT NULL
  UNION ALL SELECT 'Unidentified' AS label, y.* FROM y WHERE code IS NULL AND big_exe IS NULL
  UNION ALL SELECT 'Overall' AS label, y.* FROM y)"""

ORACLES |= {
    # scans and sinks
    "scan_steps": q(FX, f"SELECT job_id, sub_job_id, {_STR}, '0' AS mean_rss, cpu_freq FROM fx_steps"),
    "scan_jobs": q(FX, f"SELECT job_id, {_STR}, '0' AS mean_rss, cpu_freq FROM fx_jobs"),
    "scan_user_map": q(FX, "SELECT job_id, CASE WHEN job_id % 11 <> 0 AND job_id % 13 <> 0 AND job_id % 19 <> 0 THEN user_name END "
                           "AS user_name FROM fx_jobs"),
    "scan_gpu_alloc": q(FX, "SELECT concat(job_id, '.', sub_job_id) AS job_id_raw, state, concat('cpu=', ntasks, "
                            "',gres/gpu=', ngpus, ',mem=', nodes * 256, 'G,node=', nodes) AS allocation FROM fx_steps"),
    "scan_usage": q(RAW, f"SELECT CAST(job_id AS VARCHAR) AS job_id, {_STR}, '1M' AS max_rss, cpu_freq, "
                         "CAST(ngpus AS VARCHAR) AS ngpus, sub_job_id FROM u"),
    "sink_merged": q(RAW, f"SELECT {COLS}, '1M' AS max_rss FROM u"),
    "colocated_records": q(f"""{FX}, s AS (SELECT {COLS} FROM fx_steps WHERE state NOT IN {BAD} AND {_SPAN}),
 j AS (SELECT {COLS} FROM fx_jobs WHERE state NOT IN {BAD} AND {_SPAN}),
 u AS (SELECT * FROM s UNION ALL SELECT * FROM j WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.job_id = j.job_id))""",
        "SELECT u.* REPLACE (CASE WHEN u.job_id % 13 <> 0 THEN upper(x.user_name) END AS user_name) FROM u JOIN fx_jobs x ON x.job_id = u.job_id"),
    "usage_records": q(f"""{FX}, s AS (SELECT *, 0 AS src FROM fx_steps WHERE state NOT IN {BAD} AND sub_job_id <> '5'),
 j AS (SELECT *, 1 AS src FROM fx_jobs WHERE state NOT IN {BAD}),
 u AS (SELECT * FROM s UNION ALL SELECT * FROM j WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.job_id = j.job_id)),
 g AS (SELECT job_id, sub_job_id, max(ngpus) AS n FROM fx_steps GROUP BY job_id, sub_job_id)""",
        """SELECT u.job_id, u.sub_job_id, u.exe_name, u.user_name, u.account, CAST(u.nodes AS VARCHAR) AS nodes,
 CAST(u.runtime AS VARCHAR) AS runtime, CAST(CASE WHEN u.src = 0 THEN g.n ELSE u.ngpus END AS DOUBLE) AS ngpus
 FROM u LEFT JOIN g ON g.job_id = u.job_id AND g.sub_job_id = u.sub_job_id"""),
    "energy_records": q(f"{RAW}, {FIRST}", "SELECT job_id, exe_name, user_name, CAST(nodes AS VARCHAR) AS nodes, "
                        "CAST(runtime AS VARCHAR) AS runtime, CAST(energy_j AS VARCHAR) AS energy_j FROM ej"),
    "scan_energy_jobs": q(FX, f"SELECT {_STR.replace('CAST(ntasks AS VARCHAR) AS ntasks, ', '')}, job_id FROM fx_jobs"),
    "scan_step_exe": q(f"{RAW}, {FIRST}", "SELECT job_id, CASE WHEN job_id % 11 <> 0 THEN exe END AS exe_name FROM first_exe"),
    "scan_code_defs": "WITH e AS (SELECT replace(p_name, ' ', '_') AS exe, min(p_type) AS type, min(p_brand) AS brand "
                      "FROM part GROUP BY replace(p_name, ' ', '_')) "
                      "SELECT CAST(row_number() OVER (ORDER BY exe) - 1 AS INT) AS ord, exe AS name, concat('^', exe, '$') AS "
                      "pattern, brand AS language, '95' AS version, 'Free' AS academic_license, 'Fee' AS commercial_license, "
                      "type AS motif, '' AS area FROM e",
    "scan_areas": q(FX, "SELECT project_id, area FROM fx_all_areas"),
    "scan_summaries": q(_PERIODS, 'SELECT key, nodeh AS "Nodeh", kwh AS "kWh", CAST(users AS DOUBLE) AS "Users", '
                                  'CAST(projects AS DOUBLE) AS "Projects" FROM ps'),
    "combine_summaries": q(f"""{_PERIODS}, cb AS (SELECT key, list_sum(list_sort(list(kwh))) AS kwh, list_sum(list_sort(list(nodeh))) AS nodeh,
  min(users) AS u1, max(users) AS u2, min(projects) AS p1, max(projects) AS p2 FROM ps GROUP BY key),
 o AS (SELECT kwh AS k, nodeh AS n FROM cb WHERE key = 'Overall')""",
        'SELECT key, kwh AS "kWh", nodeh AS "Nodeh", u1 AS "Users_min", u2 AS "Users_max", '
        'p1 AS "Projects_min", p2 AS "Projects_max", 100 * kwh / k AS "PercentEnergy", '
        '100 * nodeh / n AS "PercentUse" FROM cb CROSS JOIN o'),
    "sched_report_rows": q(f"{FX}, {_CELLS}, {_SIZES}", "SELECT report, CAST(block AS INT) AS block, concat(block + 1, 'h') "
                           "AS runtime, size, submitted, ran, usage, wait, coefficient FROM cells JOIN sizes ON slot = size_index"),
    "sched_matrix_dense": q(_GRID, "SELECT * REPLACE (CAST(block AS INT) AS block) FROM grid"),
    "sched_matrix_hot": q(_GRID, "SELECT report, CAST(block AS INT) AS block, size, usage, ran, "
                                 "coalesce(usage / max(usage) OVER (PARTITION BY report) > 0.9, FALSE) AS hot FROM grid"),
    "sched_matrix_pivot": q(_GRID, "SELECT report, CAST(block AS INT) AS block, runtime, " + ", ".join(
        f"max(CASE WHEN size = '{s}' THEN coefficient END) AS \"{s}\"" for s in SIZES)
        + " FROM grid GROUP BY report, block, runtime"),
    "sink_result": "SELECT \"Software\", " + ", ".join(
        f"printf('%.1f', \"{c}\") AS \"{c}\"" for c in
        ["Min", "Q1", "Median", "Q3", "Max", "Nodeh", "PercentUse", "kWh", "PercentEnergy"]) + ", " + ", ".join(
        f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in ["Jobs", "Users", "Projects"])
        + f" FROM ({report_sql('CodeSize', NODEH, False)}) z",
    "empty_guard": q(FACTS, "SELECT sum(use_s) / 460800.0 AS total_use, sum(energy) / 3600000.0 AS total_kwh FROM d"),
    # cleaning and row selection
    "na_normalise": f"""WITH t AS (SELECT *, list_extract([{', '.join(text(t) for t in [*NA_TOKENS, 'na', 'none'])}],
  CAST(p_partkey % 21 + 1 AS INT)) AS tk FROM part)
 SELECT p_partkey, CASE WHEN tk IN ('na', 'none') THEN tk END AS token,
  CASE WHEN p_size > 10 THEN p_name END AS exe_name FROM t""",
    "coerce_numeric": f"""WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % {len(NUMBER_SAMPLES) + 3} < {len(NUMBER_SAMPLES)}
  THEN list_extract([{', '.join(text(x) for x in NUMBER_SAMPLES)}], CAST(l_partkey % {len(NUMBER_SAMPLES) + 3} + 1 AS INT))
  ELSE CAST(l_partkey AS VARCHAR) END AS x FROM lineitem)
 SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(x, '^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$')
  THEN TRY_CAST(replace(trim(x), '+', '') AS DOUBLE) END AS value FROM t""",
    "filter_real_steps": q(f"{FX}, {_RAW_IDS}", "SELECT * FROM ids WHERE regexp_matches(job_id_raw, '^[0-9]+[.][0-9]')"),
    "filter_first_step": q(f"{FX}, {_RAW_IDS}", "SELECT * FROM ids WHERE job_id_raw LIKE '%.0'"),
    "split_job_id": q(f"{FX}, {_RAW_IDS}", "SELECT CAST(split_part(job_id_raw, '.', 1) AS BIGINT) AS job_id, "
                                           "split_part(job_id_raw, '.', 2) AS sub_job_id, exe_name, state FROM ids"),
    "filter_states": q(FX, f"SELECT state, count(*) AS rows FROM fx_steps WHERE state NOT IN {BAD} GROUP BY state UNION ALL "
                           "SELECT state, count(*) FROM fx_jobs WHERE state NOT IN ('COMPLETED', 'FAILED') GROUP BY state"),
    "filter_time": "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem "
                   "WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'",
    "filter_attrs": q(FX, "SELECT job_id, user_name, partition_name, cpu_freq FROM fx_jobs "
                          "WHERE partition_name IN ('standard', 'highmem') AND cpu_freq = '1-URGENT'"),
    "filter_project": q(f"{RAW}, {usage_facts(NODEH)}", "SELECT f.job_id, f.sub_job_id, f.user_name, f.project_id, "
                        "lower(c.c_mktsegment) AS group_id, f.use_s FROM f JOIN customer c ON c.c_name = f.user_name "
                        "WHERE f.project_id = 'p7'"),
    "filter_dropna": q(f"{RAW}, {usage_facts(UsageConfig(drop_nan=True))}",
                       "SELECT job_id, sub_job_id, energy AS energy_j, use_s FROM f"),
    "exe_missing_policy": q(f"{RAW}, {FIRST}", "SELECT exe_name, count(*) AS rows, 'usage' AS family FROM ej WHERE exe_name IS NOT NULL "
                            "GROUP BY exe_name UNION ALL SELECT coalesce(exe_name, 'Unknown'), count(*), 'energy' FROM ej "
                            "GROUP BY coalesce(exe_name, 'Unknown')"),
    "clean_energy": q(FX, "SELECT job_id, sub_job_id, CAST(CASE WHEN energy_j <= 10000000000000000 THEN energy_j END AS DOUBLE) "
                          "AS energy_j FROM fx_steps"),
    "clean_power": q(FACTS, "SELECT job_id, sub_job_id, node_power FROM d"),
    "node_power": q(FX, "SELECT job_id, sub_job_id, CAST(energy_j AS DOUBLE) / nullif(CAST(runtime * nodes AS DOUBLE), 0) AS "
                        "node_power FROM fx_steps"),
    "energy_kwh": q(FX, "SELECT job_id, sub_job_id, CAST(energy_j AS DOUBLE) / 3600000.0 AS energy_kwh FROM fx_steps"),
    "cores_smt_cap": q(FX, "SELECT job_id, sub_job_id, CAST(CASE WHEN ntasks > 128 * nodes THEN 128 * nodes ELSE ntasks END AS DOUBLE) "
                           "AS cores FROM fx_steps"),
    "clamp_usage": q(f"{FX}, nj AS (SELECT *, 0 AS src FROM (SELECT * REPLACE (CASE WHEN job_id % 11 = 0 THEN -runtime ELSE runtime END "
                     f"AS runtime) FROM fx_steps) z), {usage_facts(NODEH, 'nj')}",
                     "SELECT job_id, sub_job_id, CASE WHEN use_s < 0 THEN 0.0 ELSE use_s END / 460800.0 AS use FROM f"),
    "usage_subnode": q(FACTS, "SELECT job_id, sub_job_id, cores, use_s / 460800.0 AS use, energy / 3600000.0 AS energy_kwh, "
                              "node_power FROM d"),
    "filter_full_node": q(FACTS, "SELECT job_id, sub_job_id, cores, node_power FROM d WHERE cores >= 128"),
    "split_account": q(FX, "SELECT job_id, split_part(account, '-', 1) AS project_id, split_part(account, '-', 2) AS group_id FROM fx_jobs"),
    "gpu_rows": q(f"{FX}, {_JOB_ALLOC}", "SELECT job_id_raw, state, allocation FROM alloc WHERE allocation LIKE '%gpu%'"),
    "parse_gpu_count": q(f"{FX}, {_JOB_ALLOC}", "SELECT job_id_raw, CASE WHEN allocation LIKE '%gres/gpu=%' "
                                                "THEN CAST(ngpus AS DOUBLE) END AS ngpus FROM alloc"),
    # assembly and joins
    "assemble_usage": q(RAW, f"SELECT {COLS} FROM u"),
    "assemble_usage_keep_last": q(f"""{RAW}, a AS (SELECT * REPLACE (CAST(CAST(sub_job_id AS BIGINT) * 2 AS VARCHAR) AS sub_job_id) FROM s UNION ALL SELECT * FROM j),
 k AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY src DESC, CAST(sub_job_id AS BIGINT) DESC, exe_name DESC, user_name DESC,
   account DESC, nodes DESC, ntasks DESC, runtime DESC, state DESC, energy_j DESC NULLS LAST, cpu_freq DESC, ngpus DESC) AS rn,
   count(*) OVER (PARTITION BY job_id) AS n FROM a)""", f"SELECT {COLS} FROM k WHERE rn > 1 OR n = 1"),
    "join_user": q(RAW, "SELECT u.job_id, u.sub_job_id, upper(x.user_name) AS user_name, u.exe_name FROM u "
                        "LEFT JOIN (SELECT * FROM fx_jobs WHERE job_id % 13 <> 0) x ON x.job_id = u.job_id"),
    "join_user_hot": q(RAW, f"""SELECT h.job_id, h.sub_job_id, upper(x.user_name) AS user_name, h.exe_name, h.runtime
  FROM (SELECT * REPLACE (CASE WHEN runtime % 20 = 0 THEN NULL WHEN runtime % 20 = 1 THEN job_id ELSE {fx.HOT_JOB} END AS job_id) FROM u) h
  LEFT JOIN (SELECT * FROM fx_jobs WHERE job_id % 13 <> 0) x ON x.job_id = h.job_id"""),
    "join_step_exe": q(f"{RAW}, {FIRST}", "SELECT job_id, exe_name, account, nodes, runtime FROM ej"),
    "join_gpu": q(f"{RAW}, {_JOB_ALLOC}", """SELECT u.job_id, u.sub_job_id, u.exe_name, CASE WHEN u.src = 0 THEN CAST(g.n AS DOUBLE)
  WHEN b.allocation LIKE '%gres/gpu=%' THEN CAST(b.ngpus AS DOUBLE) END AS ngpus FROM u
  LEFT JOIN (SELECT job_id, sub_job_id, max(ngpus) AS n FROM fx_steps GROUP BY job_id, sub_job_id) g
   ON u.src = 0 AND g.job_id = u.job_id AND g.sub_job_id = u.sub_job_id
  LEFT JOIN alloc b ON u.src = 1 AND b.job_id_raw = CAST(u.job_id AS VARCHAR)"""),
    "join_area": q(FACTS, "SELECT job_id, sub_job_id, project_id, area FROM d"),
    "classify_by_words": q(f"""{FX}, defs AS ({fx.oracle_text(fx.FX_DEFS)}),
 r AS (SELECT * REPLACE ({fx.FX_LONG_NAME} AS exe_name) FROM fx_steps), e AS (SELECT DISTINCT exe_name FROM r),
 m AS (SELECT exe_name, max(ord) AS ord FROM (
   SELECT exe_name, ord FROM e JOIN defs ON ord < 2000000000 AND regexp_matches(exe_name, pattern)
   UNION ALL SELECT exe_name, ord FROM e JOIN defs ON ord >= 2000000000 AND contains(exe_name, pattern)) GROUP BY exe_name)""",
        """SELECT job_id, sub_job_id, r.exe_name, coalesce(name, 'Unknown') AS software, coalesce(motif, 'Unknown') AS motif,
 CASE WHEN defs.ord IS NULL THEN 'Unknown' ELSE coalesce(language, '') END AS language
 FROM r LEFT JOIN m ON r.exe_name = m.exe_name LEFT JOIN defs ON m.ord = defs.ord"""),
    "classify_exe": q(FACTS, "SELECT job_id, sub_job_id, exe_name, software, motif, language FROM d"),
    "motif_tokens": q(FACTS, "SELECT DISTINCT token FROM (SELECT unnest(string_split(motif, ' ')) AS token FROM d) z WHERE token <> ''"),
    "lang_tokens": q(FACTS, "SELECT DISTINCT token FROM (SELECT unnest(string_split(language, ' ')) AS token FROM d) z WHERE token <> ''"),
    "anon_users": q(f"{FACTS}, {_FIRST_SEEN}", "SELECT user_name, anon_user FROM anon"),
    "user_split": q(f"{FACTS}, {_FIRST_SEEN}", "SELECT CASE WHEN software IN ('a.out', 'Python') THEN concat(software, '_', anon_user) "
                    "ELSE software END AS software, count(*) AS rows, sum(use_s) AS use_s FROM d JOIN anon USING (user_name) GROUP BY 1"),
    "unidentified_exes": q(f"{FACTS}, {_BIG}", 'SELECT exe_name AS "ExeName", w / 460800.0 AS "Usage", n AS "Count" FROM big'),
    "energy_unidentified_exes": q(f"{ENERGY_ALL}, {_BIG}", 'SELECT exe_name AS "ExeName", w / 3600.0 AS "Nodeh", n AS "Count" FROM big'),
    "user_split_unidentified": q(f"""{FACTS}, {_FIRST_SEEN}, {_BIG},
 x AS (SELECT d.*, anon_user FROM d JOIN anon USING (user_name)),
 l AS (SELECT CASE WHEN b.exe_name IS NOT NULL THEN concat(x.exe_name, '_', anon_user)
   WHEN software IN ('a.out', 'Python') THEN concat(software, '_', anon_user) ELSE software END AS label, x.*
   FROM x LEFT JOIN big b ON b.exe_name = x.exe_name UNION ALL SELECT 'Overall' AS label, x.* FROM x),
 {stats_ctes('cores', 460800.0)}""",
        'SELECT label AS "Software", mn AS "Min", q1 AS "Q1", q2 AS "Median", q3 AS "Q3", mx AS "Max", jobs AS "Jobs", use AS "Nodeh", '
        'percent_use AS "PercentUse", kwh AS "kWh", percent_energy AS "PercentEnergy", users AS "Users", projects AS "Projects" FROM r'),
    "user_split_named": q(f"""{FACTS}, {_BIG}, {_split_labels("SELECT d.*, user_name AS who FROM d")}, {stats_ctes('cores', 460800.0)}""",
                          _REPORT_COLUMNS),
    "project_code_size_split": q(f"""{FACTS}, {_FIRST_SEEN}, d0 AS (SELECT * FROM d WHERE project_id = '{PROJECT}'),
 {_of_project(_BIG)}, {_split_labels("SELECT d0.*, anon_user AS who FROM d0 JOIN anon USING (user_name)")},
 {_of_project(stats_ctes('cores', 460800.0))}""", _REPORT_COLUMNS),
    "project_motif_size": q(f"""{FACTS}, d0 AS (SELECT * FROM d WHERE project_id = '{PROJECT}'),
 {labelled("Motif", "substring", "TRUE").replace("FROM d WHERE", "FROM d0 WHERE")}, {_of_project(stats_ctes('cores', 460800.0))}""",
                            _REPORT_COLUMNS.replace('"Software"', '"Motif"')),
    "energy_code_size_split": q(f"{ENERGY_ALL}, {_FIRST_SEEN}, {_BIG}, {_ENERGY_SPLIT}, {stats_ctes('nodes', 3600.0)}", _REPORT_COLUMNS),
    "energy_code_power_split": q(f"{ENERGY_ALL}, {_FIRST_SEEN}, {_BIG}, {_ENERGY_SPLIT}, {stats_ctes('node_power', 3600.0)}", _REPORT_COLUMNS),
    # aggregates
    "totals": q(FACTS, "SELECT sum(use_s) / 460800.0 AS total_use, sum(energy) / 3600000.0 AS total_kwh FROM d"),
    "quality_node_power": q(FACTS, """SELECT count(*) AS rows, count(CASE WHEN cores < 128 THEN 1 END) AS excluded_rows,
  count(CASE WHEN cores < 128 THEN 1 END) * 100 / count(*) AS excluded_rows_percent,
  sum(CASE WHEN cores < 128 THEN use_s END) / 460800.0 AS excluded_use,
  sum(CASE WHEN cores < 128 THEN use_s END) * 100 / sum(use_s) AS excluded_use_percent,
  sum(CASE WHEN cores < 128 THEN energy END) / 3600000.0 AS excluded_kwh,
  sum(CASE WHEN cores < 128 THEN energy END) * 100 / sum(energy) AS excluded_kwh_percent FROM d"""),
    "distinct_values": q(FACTS, """SELECT DISTINCT 'project_id' AS "column", project_id AS value FROM d UNION
  SELECT 'user_name', user_name FROM d UNION SELECT 'cpu_freq', cpu_freq FROM d"""),
    "running_usage": q(f"{FACTS}, {_SIZED}", """SELECT software, value, sum(use_s) OVER (PARTITION BY software ORDER BY value
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 460800.0 AS running_use,
  sum(use_s) OVER (PARTITION BY software) / 460800.0 AS total_use FROM cs"""),
    "top_codes": q(FACTS, "SELECT software, sum(use_s) / 460800.0 AS use FROM d GROUP BY software ORDER BY use DESC, software LIMIT 15"),
    "code_use_ranking": q(FACTS, 'SELECT software AS "Software", sum(use_s) / 460800.0 AS "Nodeh", '
                                 'sum(use_s) * 100 / (SELECT sum(use_s) FROM d) AS "PercentUse" FROM d GROUP BY software'),
    "weighted_expand": q(FACTS, "SELECT job_id, sub_job_id, cores, unnest(range(1, CAST(floor(use_s / 460800.0) AS BIGINT) + 1)) AS copy FROM d"),
    "top_code_boxstats": q(f"""{FACTS}, top AS (SELECT software, sum(use_s) AS total FROM d GROUP BY software ORDER BY total DESC, software LIMIT 15),
 ex AS (SELECT software, cores, unnest(range(CAST(floor(use_s / 460800.0) AS BIGINT))) AS i FROM d WHERE software IN (SELECT software FROM top)),
 bx AS (SELECT software, quantile_cont(cores, 0.25) AS q1, quantile_cont(cores, 0.5) AS median, quantile_cont(cores, 0.75) AS q3,
   sum(cores) / count(*) AS mean, count(*) AS copies FROM ex GROUP BY software)""",
        """SELECT top.software, max(bx.q1) AS q1, max(median) AS median, max(q3) AS q3, max(mean) AS mean, max(copies) AS copies,
  least(min(CASE WHEN cores >= q1 - (q3 - q1) * 1.5 THEN cores END), max(q1)) AS whisker_low,
  greatest(max(CASE WHEN cores <= q3 + (q3 - q1) * 1.5 THEN cores END), max(q3)) AS whisker_high,
  max(total) / 460800.0 AS use FROM top LEFT JOIN ex USING (software) LEFT JOIN bx USING (software) GROUP BY top.software"""),
    "report_projection": report_sql("ProjSize", NODEH, False, energy_columns=False),
    "energy_report_projection": report_sql("AreaSize", ENERGY, False, use_columns=False, absolute_energy=False),
}

_QUALITY = """SELECT count(*) AS rows, count(*) - count(energy) AS missing_rows,
  (count(*) - count(energy)) * 100 / count(*) AS missing_rows_percent,
  coalesce(sum(CASE WHEN energy IS NULL THEN use_s END), 0) / {d} AS missing_use,
  coalesce(sum(CASE WHEN energy IS NULL THEN use_s END), 0) * 100 / sum(use_s) AS missing_use_percent FROM d"""
ORACLES["quality_energy"] = q(FACTS, _QUALITY.format(d="460800.0"))
ORACLES["quality_energy_jobs"] = q(ENERGY_ALL, _QUALITY.format(d="3600.0"))

_PROJ = ", ".join([FACTS, labelled("ProjectID", "equality", "TRUE"), stats_ctes("cores", 460800.0)])
ORACLES["overall_stats"] = q(_PROJ, "SELECT label, use, percent_use, kwh, percent_energy, jobs, users, projects FROM r")
ORACLES["dist_unweighted"] = q(_PROJ, "SELECT label, mn AS min, q1, q2 AS median, q3, mx AS max FROM r")
ORACLES["dist_weighted"] = q(_PROJ, "SELECT label, wq1 AS q1, wq2 AS median, wq3 AS q3 FROM r")

for _key, _cfg in {
    "usage_nodeh": UsageConfig(shared_node=True), "usage_coreh": UsageConfig(units="Coreh"),
    "usage_coreh_reference": UsageConfig(units="Coreh", coreh_subnode="reference"),
    "usage_gpuh": UsageConfig(gpu=True, shared_node=True), "usage_gpu_subnode": UsageConfig(gpu=True),
}.items():
    ORACLES[_key] = q(f"{RAW}, {usage_facts(_cfg)}",
                      f"SELECT job_id, sub_job_id, use_s / {_cfg.use_divisor} AS use FROM f")

# Over all periods, and within the bound of approximate quartiles: what the exact reports say.
ORACLES["periods_code_size"] = ORACLES["dist_code_size"]
ORACLES["periods_energy_code_power"] = ORACLES["energy_code_power"]
ORACLES["periods_user_split"] = ORACLES["user_split_unidentified"]
ORACLES["approx_code_power"] = "SELECT Software, Jobs, " + ", ".join(
    f"true AS {q}_near" for q in ("q1", "q2", "q3", "wq1", "wq2", "wq3")) + f" FROM ({ORACLES['dist_code_power']})"
