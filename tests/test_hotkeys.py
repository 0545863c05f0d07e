"""Joins on hot keys: the same rows as a plain join, in tasks of like size."""

import statistics

import pytest
from pyspark.sql import functions as F

from jobuse.config import UsageConfig
from jobuse.operators.hotkeys import HotKeys, hot_keys, join_split
from jobuse.plans import runs


@pytest.fixture
def shuffled(spark):
    """Neither broadcasts nor adaptive changes: what the join itself does is seen."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark, n=100_000):
    """Nine rows in ten on job 7, one in twenty on null, the rest on many."""
    job = F.when(F.col("id") % 20 == 0, None).when(F.col("id") % 20 == 1, F.col("id")).otherwise(7)
    return spark.range(n).select(job.alias("job_id"), F.col("id").alias("n"), F.lit("x").alias("user_name"))


def test_tasks_are_alike_however_hot_a_job(shuffled):
    rows = skewed(shuffled)
    values = shuffled.range(60_000).select(F.col("id").alias("job_id"), F.lit("u").alias("user"))
    hot = hot_keys(rows)
    assert set(hot.parts) == {7, None} and sum(hot.parts.values()) <= 16 * 32 + 2
    joined = join_split(rows, values, ["job_id"], hot)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * statistics.median(sizes) and sum(sizes) == 100_000
    plain = rows.join(values, ["job_id"], "left")
    plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(plain_sizes) > 10 * statistics.median(plain_sizes)
    assert joined.columns == plain.columns


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_rows_are_those_of_a_plain_join(spark, how):
    rows = skewed(spark, 2_000).unionByName(skewed(spark, 40))
    values = spark.createDataFrame([(7, "a"), (7, "b"), (21, "c"), (None, "d"), (41, None)], "job_id long, _part string")
    for hot in (hot_keys(rows), HotKeys("job_id", {}), HotKeys("job_id", {None: 3}), HotKeys("job_id", {21: 5, 999: 2})):
        got = join_split(rows, values, ["job_id"], hot, how)
        expected = rows.join(values, ["job_id"], how)
        assert got.columns == expected.columns
        assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_no_rows_and_no_hot_keys(spark):
    assert hot_keys(skewed(spark, 0)).parts == {}
    assert hot_keys(spark.range(50_000).select(F.col("id").alias("job_id"))).parts == {}
    nulls = spark.range(100).select(F.lit(None).cast("long").alias("job_id"))
    assert set(hot_keys(nulls).parts) == {None}
    assert join_split(nulls, spark.createDataFrame([(1, "v")], "job_id long, v string"), ["job_id"], hot_keys(nulls)).count() == 100


def test_records_of_skewed_dumps(spark):
    """A run with hot job ids split has the records of one without."""
    schema = "job_id_raw string, user_name string, exe_name string, state string, n long"
    steps = spark.range(3_000).select(F.when(F.col("id") % 10 < 9, F.concat(F.lit("7."), "id")).otherwise(F.concat("id", F.lit(".0"))).alias("job_id_raw"),
                                      F.lit("x").alias("user_name"), F.lit("exe").alias("exe_name"), F.lit("COMPLETED").alias("state"), F.col("id").alias("n"))
    jobs = spark.createDataFrame([(str(k), "x", None, "COMPLETED", k) for k in range(40)] + [("odd", "x", None, "COMPLETED", -1)] * 30, schema)
    users = spark.createDataFrame([(7, "ann"), (9, "bob"), (12, "kim")], "job_id long, user_name string")
    cfg = UsageConfig()
    split, plain = (runs.usage_records(steps, jobs, users, cfg, split_hot=on) for on in (True, False))
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
