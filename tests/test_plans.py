"""Shape of the plans: what is read, what is broadcast, what must not appear."""

import datetime as dt
import os
import re

import pytest

from catalog import fixtures as fx
from catalog.queries import GPU_LAYOUT, NODEH, QUERIES, SPLIT, STEP_LAYOUT, _dumps, bucketed, colocated, facts
from jobuse import session
from jobuse.operators import stats
from jobuse.operators.classify import definition_index
from jobuse.plans import analyses, runs
from jobuse.sources import tables
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "assemble_usage", "assemble_usage_keep_last", "classify_exe", "classify_by_words", "join_user", "join_gpu", "join_area", "join_step_exe",
    "anon_users", "dist_code_power", "dist_area_size", "energy_area_size", "user_split_unidentified",
    "sched_matrix_dense", "combine_summaries", "top_code_boxstats"])
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_time_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["filter_time"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


def test_tagging_is_a_projection(spark):
    stored = spark.createDataFrame([("x",)], "exe_name string")
    from jobuse.operators.classify import with_classes
    plan = plan_of(with_classes(stored, fx.dictionary()))
    assert "Exchange" not in plan and "Join" not in plan


def test_the_pass_over_facts_combines_before_its_only_shuffle(spark, tmp_path):
    """From a stored fact table: scan, expand, partial aggregate, exchange - nothing else."""
    path = str(tmp_path / "facts")
    facts(spark, SF).write.parquet(path)
    reports = [stats.Report({"code": definition_index(F.col("exe_name"), fx.dictionary())}, stats.Measure(NODEH.size_measure), None)]
    plan = plan_of(stats.Cube(stats.base_rows(spark.read.parquet(path), reports), reports).rows)
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Sort" not in plan
    assert plan.index("Exchange") < plan.index("partial_sum") < plan.index("Expand") < plan.index("FileScan")
    assert "node_power" not in plan and "job_id" not in plan


def test_bucketed_tables_are_assembled_where_they_lie(spark):
    """No shuffle above the scans, and only the folders of the months asked for."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = colocated(*bucketed(spark, SF, buckets=4))
        plan = plan_of(records)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        assert plan.count("PartitionFilters: [isnotnull(period") == 3 and "Bucketed: true" in plan
        assert records.count() > 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_bucketed_table_is_found_again(spark, tmp_path):
    rows = spark.sql("SELECT id % 50 AS job_id, id AS n, timestamp '2024-01-15' + make_interval(0, id % 5) AS started FROM range(400) "
                     "UNION ALL SELECT 7, 400, NULL")
    path = str(tmp_path / "t")
    first = tables.write_table(rows, "bucketed_first", path, 4, "started")
    again = tables.attach_table(spark, "bucketed_again", path, "job_id BIGINT, n BIGINT, started TIMESTAMP", 4, "started")
    assert sorted(again.drop("period").collect(), key=str) == sorted(first.drop("period").collect(), key=str) == sorted(rows.collect(), key=str)
    some = tables.rows_between(again, "started", dt.datetime(2024, 2, 1), dt.datetime(2024, 4, 1))
    assert sorted(r.n for r in some.collect()) == [n for n in range(400) if n % 5 in (1, 2)]
    assert "Exchange" not in plan_of(again.groupBy("job_id").count())
    for name in ("bucketed_first", "bucketed_again"):
        spark.sql(f"DROP TABLE {name}")


def test_tasks_do_not_grow_with_the_input(spark):
    """Shuffle partitions and buckets follow the bytes of the input; settings finer than that stay."""
    parts, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    session.fit_shuffles(other, 1 << 20)
    assert other.conf.get(parts, None) is None and int(other.conf.get(size)) == 16 << 20
    session.fit_shuffles(other, 4 << 30)
    session.fit_shuffles(other, 1 << 30)
    assert int(other.conf.get(parts)) == 1024
    other.conf.set(size, "8m")
    fx.steps(other, SF)
    assert other.conf.get(size) == "8m" and int(other.conf.get(parts)) == 1024
    assert [tables.bucket_count(n << 20) for n in (1, 128, 1024, 6144)] == [8, 8, 64, 384]
    assert session.input_bytes(spark, list(fx.table_paths(SF, fx.FX_SCHED).values())) == os.path.getsize(f"{SF}/orders.parquet")


def test_gpu_counts_are_shuffled_once(spark):
    """Counts of steps and of jobs together: one shuffle serves counting and joining."""
    steps = spark.createDataFrame([], ", ".join(f"{c} string" for c in STEP_LAYOUT[0]))
    gpus = spark.createDataFrame([], ", ".join(f"{c} string" for c in GPU_LAYOUT[0]))
    users = spark.createDataFrame([], "job_id bigint, user_name string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        without, with_gpus = (plan_of(runs.usage_records(steps, steps, users, NODEH, *some)).count("Exchange hashpartitioning")
                              for some in ([], [gpus, gpus]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert with_gpus - without == 2


def test_dumps_are_made_in_one_pass(spark):
    """Both dumps of the same rows, compressed and in files of bounded rows, and folders for no rows."""
    rows = fx.steps(spark, SF).withColumns({"job_id_raw": F.concat_ws(".", "job_id", "sub_job_id"), "allocation": F.lit("gres/gpu=1"),
                                            "max_rss": F.lit(None).cast("string"), "mean_rss": F.lit("0")})
    folders = _dumps(rows, entries=STEP_LAYOUT, gpu=GPU_LAYOUT)
    for kind, (columns, sep) in {"entries": STEP_LAYOUT, "gpu": GPU_LAYOUT}.items():
        lines = rows.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))
        read = spark.read.text(folders[kind])
        assert read.columns == ["value"] and sorted(r[0] for r in read.collect()) == sorted(r[0] for r in lines.collect())
        plain = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]
        assert session.input_bytes(spark, [folders[kind]]) < plain / 2
    assert os.path.dirname(folders["entries"]) == os.path.dirname(folders["gpu"])
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == session.READ_BYTES
    empty = _dumps(rows.limit(0), entries=STEP_LAYOUT, gpu=GPU_LAYOUT)
    assert [spark.read.text(path).count() for path in empty.values()] == [0, 0]


def test_labels_with_users_are_shuffled_once(spark, monkeypatch):
    """Rows of labels that carry the user are neither cut into cells that are written, nor shuffled again."""
    base, plans, rows_cut, cut, short_labels = facts(spark, SF), [], [], session.cut, stats.short_labels

    def counted(df):
        rows_cut.append(df.count())
        return cut(df)

    def watched(*args):
        plans.append(plan_of(short_labels(*args)))
        return short_labels(*args)

    monkeypatch.setattr(stats, "cut", counted)
    monkeypatch.setattr(stats, "short_labels", watched)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = analyses.report(base, "CodeSize", SPLIT, dictionary=fx.dictionary())
        labels = report.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert labels > 500 and sum(rows_cut) < labels
    exchanges = [x for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plans[0]) if "_key" in x or "label" in x]
    assert len(exchanges) == 1 and "," not in exchanges[0]


def test_lines_are_shuffled_twice(spark):
    """By part and by order; customers join the orders, and steps lie by job id afterwards."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fx.steps(spark, SF))
        assert plan_of(fx.steps(spark, SF).groupBy("job_id").count()).count("Exchange") == plan.count("Exchange")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "lineitem.parquet" in line)
    depth, over = re.search(r"\w", lines[at]).start(), []
    for line in lines[at - 1::-1]:
        if re.search(r"\w", line).start() < depth:
            depth = re.search(r"\w", line).start()
            over.append(line)
    assert [re.search(r"\((\w+)", line)[1] for line in over if "Exchange" in line] == ["l_partkey", "l_orderkey"]
