"""Whole runs: records from dump files, reports to files, project and user options."""

import os
from dataclasses import replace

from pyspark.sql import functions as F

from catalog import fixtures
from catalog.queries import NODEH, facts as fixture_facts
from jobuse.config import UsageConfig
from jobuse.operators.rollup import combine_summaries
from jobuse.plans import analyses, periods, runs
from jobuse.plans.facts import usage_facts
from jobuse.session import shared_dir
from jobuse.sources import dumps
from jobuse.sources.definitions import Dictionary

DICT = Dictionary.of(("App", "app", "Grid", "C"), ("Other", "other", "GridLike", "C"), ("Python", "py", "", "Python"))

STEPS = """1.0::app::x::z1-a::2::256::3600::COMPLETED::720000::1::1::2000
1.batch::app::x::z1-a::2::256::3600::COMPLETED::720000::1::1::2000
1.1::py::x::z1-a::1::32::3600::COMPLETED::::1::1::2000
2.0::py::x::z2::1::128::7200::RUNNING::1::1::1::2000
4.0::other::x::z2-b::1::128::7200::COMPLETED::1::1::1::2000
"""
JOBS = """1::job::x::z1-a::2::256::3600::COMPLETED::720000::::::2000
2::job::x::z2::1::128::7200::COMPLETED::1440000::::::2000
3::job::x::z1::1::128::60::REQUEUED::1::::::2000
4::job::x::z2-b::1::128::7200::COMPLETED::1::::::2000
"""
USERS = "JobID,User\n1, ann\n2, bob\n4, cat\n"


def records(spark, folder, cfg=UsageConfig()):
    for name, text in {"steps": STEPS, "jobs": JOBS, "users": USERS}.items():
        (folder / name).write_text(text)
    return runs.usage_records(
        dumps.read_steps(spark, str(folder / "steps")), dumps.read_jobs(spark, str(folder / "jobs")),
        dumps.read_user_map(spark, str(folder / "users")), cfg)


def test_records_from_dumps(spark, tmp_path):
    got = {(r.job_id, r.sub_job_id, r.exe_name, r.user_name) for r in records(spark, tmp_path).collect()}
    assert got == {(1, "0", "app", "ann"), (1, "1", "py", "ann"), (2, "0", "no_srun", "bob"), (4, "0", "other", "cat")}


def test_written_reports(spark, tmp_path):
    cfg = UsageConfig(report_energy=True)
    paths = runs.write_reports(records(spark, tmp_path), ["CodeSize", "CodePower"], cfg, str(tmp_path / "out"), "use",
                               dictionary=DICT)
    assert set(paths) - {"Unidentified", "Quality"} == {"CodeSize", "CodeSize_weighted", "CodePower", "CodePower_weighted"}
    rows = {r.Software: r for r in spark.read.csv(paths["CodeSize"], header=True).collect()}
    assert set(rows) == {"App", "Python", "Other", "Unknown", "Overall"}
    assert (rows["App"].Nodeh, rows["App"].Jobs, rows["Overall"].Nodeh, rows["Python"].Nodeh) == ("2.0", "1", "6.2", "0.2")
    assert spark.read.csv(paths["CodePower"], header=True).filter("Software = 'Python'").count() == 0


def test_written_periods_roll_up(spark, tmp_path):
    cfg = UsageConfig(report_energy=True)
    raw = records(spark, tmp_path)
    for period, part in (("2023", raw), ("2024", raw.filter("job_id <> 4"))):
        runs.write_reports(part, ["CodeSize"], cfg, str(tmp_path / "out"), period, dictionary=DICT)
    summaries = dumps.read_summaries(spark, str(tmp_path / "out"), "CodeSize", key="Software")
    got = {r.Software: r for r in combine_summaries(summaries, "Software").collect()}
    assert (got["App"].Nodeh, got["Other"].Nodeh, got["Overall"].Nodeh) == (4.0, 2.0, 10.4)
    assert (got["Overall"].Users_min, got["Overall"].Users_max, got["Other"].Users_min) == (2, 3, 1)


def test_nothing_is_written_without_records(spark, tmp_path):
    cfg = UsageConfig(account="nobody")
    assert runs.write_reports(records(spark, tmp_path), ["CodeSize"], cfg, str(tmp_path / "out"), "use",
                              dictionary=DICT) == {}


def test_project_restriction_comes_after_labels(spark, tmp_path):
    raw = records(spark, tmp_path)
    cfg = UsageConfig(account="z2", user_split=True)
    everyone, facts = usage_facts(raw, cfg, for_account=False), usage_facts(raw, cfg)
    # Motif words come from all projects: 'Grid' is inside 'GridLike', though no z2 row is labelled Grid itself.
    motifs = analyses.report(facts, "MotifSize", cfg, dictionary=DICT, all_facts=everyone)
    assert {r.Motif: r.Jobs for r in motifs.collect()} == {"Grid": 1, "GridLike": 1, "Unknown": 1, "Overall": 2}
    # Users are numbered over all projects, and shares are of the project.
    codes = analyses.report(facts, "CodeSize", cfg, dictionary=DICT, all_facts=everyone)
    got = {r.Software: r for r in codes.collect()}
    assert set(got) == {"Other", "no_srun_user2", "Overall"}
    assert got["Overall"].PercentUse == 100


def test_energy_records_take_the_first_step(spark, tmp_path):
    for name, text in {"jobs": "1::j::ann::z1::1::60::COMPLETED::5\n2::j::bob::z1::1::60::PENDING::5\n"
                               "3::j::bob::z1::1::60::FAILED::5\n"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "steps").write_text("1.0, zz\n1.0, app\n1.10, no\n3.1, no\n")
    steps = dumps.read_step_exe_rows(spark, str(tmp_path / "steps"))
    got = runs.energy_records(dumps.read_energy_jobs(spark, str(tmp_path / "jobs")), steps, UsageConfig(family="energy"))
    assert {r.job_id: r.exe_name for r in got.collect()} == {1: "app", 3: None}


def test_both_tables_differ_in_quartiles_only(spark, tmp_path):
    facts = usage_facts(records(spark, tmp_path), replace(UsageConfig(), report_energy=True))
    plain, weighted = (analyses.report(facts, "CodeSize", UsageConfig(report_energy=True), w, dictionary=DICT)
                       .drop("Q1", "Median", "Q3") for w in (False, True))
    assert plain.exceptAll(weighted).count() == 0 and plain.filter(F.col("Software") == "Overall").count() == 1


def test_stored_facts_are_removed(spark, tmp_path):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    runs.write_reports(records(spark, tmp_path), ["CodeSize", "CodePower"], UsageConfig(report_energy=True),
                       str(tmp_path / "out"), "use", dictionary=DICT)
    left = set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before
    assert all(x.startswith("rdd-") for x in left)


def test_eleven_reports_scan_the_facts_twice(spark):
    """All reports of a run from one cube: a pass for the cells, a pass for the values of node power."""
    facts = fixture_facts(spark, "/root/testdata/sf0.001").cache()
    total, seen = facts.count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    watched = facts.mapInArrow(counted, facts.schema)
    asked = list(analyses.USAGE_ANALYSES.values())
    inputs = {"dictionary": fixtures.dictionary(), "areas": fixtures.areas(spark, "/root/testdata/sf0.001")}
    found = analyses.distributions_of(watched, asked, NODEH, is_stored=True, **inputs)
    rows = [sorted(map(tuple, f.collect()), key=str) for f in found]
    assert len(asked) == 11 and seen.value == 2 * total
    for analysis, together in zip(asked, rows):
        alone = analyses.distribution_of(facts, analysis, NODEH, **inputs)
        assert sorted(map(tuple, alone.collect()), key=str) == together
    facts.unpersist()


def test_two_periods_merge_to_the_report_over_both(spark, tmp_path):
    """Size, power, users and projects, and user labels; a period that is not asked for is not read."""
    facts = fixture_facts(spark, "/root/testdata/sf0.001").cache()
    folder, period = str(tmp_path / "periods"), F.concat(F.lit("p"), F.col("job_id") % 3)
    periods.write_periods(facts, period, NODEH, folder, power=True)
    two = facts.filter(period.isin("p0", "p2"))
    for cfg in (NODEH, replace(NODEH, user_split=True)):
        names = ["CodeSize", "CodePower", "ProjSize"]
        merged = periods.reports_over(spark, folder, names, cfg, ["p0", "p2"], dictionary=fixtures.dictionary())
        for name in names:
            direct = analyses.report(two, name, cfg, dictionary=fixtures.dictionary())
            assert direct.collect() == merged[name].collect(), name
    read = periods.read_periods(spark, folder, ["p1"]).inputFiles()
    assert read and all("period=p1" in f for f in read)
    facts.unpersist()


def test_approximate_quartiles_need_one_pass(spark):
    facts = fixture_facts(spark, "/root/testdata/sf0.001").cache()
    total, seen = facts.count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    asked = [analyses.USAGE_ANALYSES[n] for n in ("CodePower", "CPUFreqPower")]
    cfg = replace(NODEH, approx=True)
    near = analyses.distributions_of(facts.mapInArrow(counted, facts.schema), asked, cfg, dictionary=fixtures.dictionary())
    exact = analyses.distributions_of(facts, asked, NODEH, dictionary=fixtures.dictionary())
    for a, b in zip(near, exact):
        rows = {r["label"]: r for r in b.collect()}
        for r in a.collect():
            want = rows.pop(r["label"])
            for c in a.columns:
                assert r[c] == want[c] if c.lstrip("w") not in ("q1", "q2", "q3") else abs(r[c] - want[c]) <= 850 / 65_536
        assert not rows
    assert seen.value == total
    facts.unpersist()
