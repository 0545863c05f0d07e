"""Cleaning, parsing, measures, assembly and labels on small literal frames."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobuse.config import UsageConfig
from jobuse.functions import scalars as s
from jobuse.operators import assemble, classify, filters, identity, joins, matrix, rollup, stats
from jobuse.operators.hotkeys import HotKeys, hot_keys
from jobuse.plans import analyses
from jobuse.plans.facts import energy_facts, usage_facts
from jobuse.sources.definitions import Dictionary

RAW = ("job_id bigint, sub_job_id string, exe_name string, user_name string, account string, nodes string, "
       "ntasks string, runtime string, state string, energy_j string, cpu_freq string")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_numbers(spark):
    texts = ["1e5", " 12 ", "inf", "-Infinity", "12K", "1.5d", "1f", "NaN", "", None, "1,000", "0x10",
             "18446744073709551614", ".5", "+7.", "1e", "--1"]
    found = values(spark, texts, s.to_number)
    assert found == [1e5, 12.0, float("inf"), float("-inf"), None, None, None, None, None, None, None, None,
                     18446744073709551614.0, 0.5, 7.0, None, None]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("None", 1), ("null", 2), ("none", 3), ("vasp", 4), ("", 5), (None, 6)],
                               "exe string, n int")
    assert [r[0] for r in s.normalise_na(df).orderBy("n").collect()] == [None, None, "none", "vasp", None, None]


def test_accounts(spark):
    found = values(spark, ["z19-x", "z19-x-y", "z19", None], lambda c: F.struct(s.project_of(c), s.group_of(c)))
    assert [tuple(r) for r in found] == [("z19", "x"), ("z19", "x-y"), ("z19", None), (None, None)]


def test_job_ids(spark):
    found = values(spark, ["12.0", "12.batch", "12", "x.1", "12.0.1"],
                   lambda c: F.struct(s.job_id_of(c), s.sub_job_id_of(c)))
    assert [tuple(r) for r in found] == [(12, "0"), (12, "batch"), (12, None), (None, "1"), (12, "0.1")]


def test_gpu_counts(spark):
    found = values(spark, ["billing=256,cpu=256,gres/gpu=4,mem=1G,node=1", "cpu=4,mem=1G", None, "gres/gpu=x",
                           "gres/gpu=2,gres/gpu:a100=2"], s.gpu_count)
    assert found == [4.0, None, None, None, 2.0]


def raw(spark, **changes):
    row = dict(job_id=1, sub_job_id="0", exe_name="x", user_name="u", account="a-b", nodes="2", ntasks="256",
               runtime="3600", state="COMPLETED", energy_j="720000", cpu_freq="2000000") | changes
    return spark.createDataFrame([tuple(row.values())], RAW)


def test_full_node_measures(spark):
    r = one(usage_facts(raw(spark), UsageConfig()))
    assert (r.cores, r.use_s / UsageConfig().use_divisor, r.energy_j, r.node_power) == (256, 2.0, 720000, 100.0)


def test_sub_node_is_prorated(spark):
    r = one(usage_facts(raw(spark, nodes="1", ntasks="32"), UsageConfig()))
    assert (r.use_s / 460800, r.energy_j, r.node_power) == (0.25, 180000, 50.0)
    cfg = UsageConfig(shared_node=True)
    r = one(usage_facts(raw(spark, nodes="1", ntasks="32"), cfg))
    assert (r.use_s / cfg.use_divisor, r.energy_j, r.node_power) == (1.0, 720000, 200.0)


def test_core_hours(spark):
    small = raw(spark, nodes="1", ntasks="32")
    for kind, small_use in (("fixed", 32.0), ("reference", 0.25)):
        cfg = UsageConfig(units="Coreh", coreh_subnode=kind)
        assert one(usage_facts(small, cfg)).use_s / cfg.use_divisor == small_use
        assert one(usage_facts(raw(spark), cfg)).use_s / cfg.use_divisor == 256.0


def test_gpu_hours(spark):
    cfg = UsageConfig(gpu=True)
    for count, use in ((1, 0.25), (4, 4.0), (8, 8.0), (None, None)):
        r = one(usage_facts(raw(spark).withColumn("ngpus", F.lit(count).cast("string")), cfg))
        assert (None if r.use_s is None else r.use_s / cfg.use_divisor) == use


def test_smt_and_zero_divisors(spark):
    assert one(usage_facts(raw(spark, ntasks="512"), UsageConfig())).cores == 256
    r = one(usage_facts(raw(spark, nodes="0", ntasks="5"), UsageConfig()))
    assert (r.cores, r.use_s, r.node_power) == (0, 0, None)
    assert one(usage_facts(raw(spark, runtime="0"), UsageConfig())).node_power is None
    r = one(usage_facts(raw(spark, ntasks="12K"), UsageConfig()))
    assert (r.cores, r.use_s / 460800) == (None, 2.0)


def test_implausible_readings(spark):
    assert one(usage_facts(raw(spark, energy_j="2e16"), UsageConfig())).energy_j is None
    r = one(usage_facts(raw(spark, energy_j="72000000"), UsageConfig()))
    assert (r.energy_j, r.node_power) == (72000000, None)
    assert one(usage_facts(raw(spark, energy_j="72000000"), UsageConfig(max_power=2e4))).node_power == 1e4
    assert one(usage_facts(raw(spark, runtime="-5"), UsageConfig())).use_s == 0
    assert one(usage_facts(raw(spark, runtime="inf"), UsageConfig())).use_s is None


def test_drop_nan(spark):
    cfg = UsageConfig(drop_nan=True)
    assert usage_facts(raw(spark), cfg).count() == 1
    assert usage_facts(raw(spark, cpu_freq=None), cfg).count() == 0
    assert usage_facts(raw(spark, runtime="0"), cfg).count() == 1                  # x/0 is not missing
    assert usage_facts(raw(spark, runtime="0", energy_j="0"), cfg).count() == 0    # 0/0 is


def test_missing_executable(spark):
    df = raw(spark, exe_name=None)
    assert usage_facts(df, UsageConfig()).count() == 0
    assert one(energy_facts(df, UsageConfig(family="energy"))).exe_name == "Unknown"


def test_bad_parameters():
    with pytest.raises(ValueError):
        UsageConfig(units="Wh")
    with pytest.raises(ValueError):
        UsageConfig(family="energy", gpu=True)


def test_state_filter_looks_at_the_state_only(spark):
    df = spark.createDataFrame([("RUNNING_job", "COMPLETED"), ("x", "RUNNING"), ("y", None), ("z", "REQUEUED")],
                               "exe_name string, state string")
    assert {r.exe_name for r in filters.kept_states(df).collect()} == {"RUNNING_job", "y"}


# ---- assembly ------------------------------------------------------------------

def ids(spark, rows):
    return spark.createDataFrame(rows, "job_id bigint, sub_job_id string, exe_name string")


def test_assembly_modes(spark):
    steps = ids(spark, [(1, "0", "a"), (1, "1", "b"), (2, "0", "c"), (4, "0", "d"), (4, "1", "e"), (5, "0", "f"),
                        (5, "0", "f")])
    jobs = ids(spark, [(1, None, "j"), (2, None, "j"), (3, None, "j")])
    got = {(r.job_id, r.exe_name) for r in assemble.assemble_usage(steps, jobs).collect()}
    assert got == {(1, "a"), (1, "b"), (2, "c"), (3, "no_srun"), (4, "d"), (4, "e"), (5, "f")}
    # Steps whose job row is missing lose their last row under the other rule.
    last = sorted((r.job_id, r.exe_name) for r in assemble.assemble_usage(steps, jobs, "keep_last").collect())
    assert last == [(1, "a"), (1, "b"), (2, "c"), (3, "no_srun"), (4, "d"), (5, "f")]


def test_lookup_joins_agree(spark):
    rows = spark.range(200).select((F.col("id") % 3).cast("string").alias("k"), "id")
    table = spark.createDataFrame([("0", "zero"), ("1", "one")], "k string, v string")
    small = joins.lookup(rows, table, "k")
    found = sorted(map(tuple, small.collect()), key=str)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup(rows, table, "k")
        assert sorted(map(tuple, large.collect()), key=str) == found
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_last_step_is_that_of_greatest_number(spark):
    schema = "job_id bigint, sub_job_id string, exe_name string, user_name string"
    steps = spark.createDataFrame([(1, str(k), f"e{k}", "u") for k in range(12)] + [(2, "batch", "b", "u"), (2, "3", "c", "u")], schema)
    got = assemble.assemble_usage(steps, spark.createDataFrame([], schema), "keep_last")
    assert sorted((r.job_id, r.exe_name) for r in got.collect()) == sorted([(1, f"e{k}") for k in range(11)] + [(2, "b")])


def odd_jobs(spark, n=3000):
    """Ids missing or hot, zero beside null, steps alike, missing, empty or without a number, and rows alike."""
    rng = random.Random(5)
    return spark.createDataFrame([
        (rng.choice([None, 0, 1, 7, 7, 7, *range(100, 900)]), rng.choice([None, "", "0", "1", "01", "2", "10", "batch"]),
         rng.choice([None, "a", "b"]), rng.choice([None, "u", "v"]), rng.choice([None, 0, 5]), rng.choice([0, 0, 1]))
        for _ in range(n)], "job_id bigint, sub_job_id string, exe_name string, user_name string, nodes bigint, src int")


def without_last(rows):
    """The rule in plain Python: the last row by source, step number, then all columns, of each repeated id goes."""
    def place(r):
        step = r.sub_job_id
        number = int(step) if step and step.isdigit() else None
        return [(v is not None, v) if v is not None else (False,) for v in (r.src, number, step, r.exe_name, r.user_name, r.nodes)]

    left = []
    for job in {r.job_id for r in rows}:
        of_job = sorted((r for r in rows if r.job_id == job), key=place)
        left += of_job[:-1] if len(of_job) > 1 else of_job
    return Counter(map(tuple, left))


@pytest.mark.parametrize("named", [None, {7: 4, None: 9}])
def test_last_of_repeated_on_odd_rows(spark, named):
    rows = odd_jobs(spark)
    hot = HotKeys("job_id", named) if named else None
    left = assemble.drop_last_of_repeated(rows, hot)
    assert left.columns == rows.columns
    assert Counter(map(tuple, left.collect())) == without_last(rows.collect())


def test_last_of_repeated_shuffles_rows_once(spark):
    """Whole rows are written to one shuffle; what tells the last ones is narrow, and rows without an id are spread."""
    names = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 97).alias("job_id"), (F.col("id") % 5).cast("string").alias("sub_job_id"),
        names.alias("exe_name"), F.lit(0).alias("src"))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = assemble.drop_last_of_repeated(rows)
        sizes = Counter(left.select(F.spark_partition_id(), "job_id").filter("job_id IS NULL").rdd.map(lambda r: r[0]).collect())
        left.collect()
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    shuffles = [line for line in plan[:plan.index("== Initial Plan ==")].splitlines() if "Exchange hashpartitioning" in line]
    made = [line for line in shuffles if "ReusedExchange" not in line]
    assert len(made) == 3 and sum("REPARTITION_BY_COL" in line for line in made) == 1 and len(shuffles) == 4
    assert sum(sizes.values()) == 1999 and max(sizes.values()) < 1000


def test_long_labels_are_matched_inside(spark):
    long = "".join(chr(97 + k % 23) for k in range(2000))
    values = spark.createDataFrame([(long,), ("abc",), ("x",), (long[5:900],), (None,), ("",)], "v string")
    found = {(r.v, r.inner) for r in classify.contained_values(values, "v").collect()}
    all_values = [long, "abc", "x", long[5:900]]
    assert found == {(a, b) for a in all_values for b in all_values if b in a}


def test_gpu_join_keeps_steps_and_jobs_apart(spark):
    alloc = "job_id_raw string, state string, allocation string"
    steps = assemble.gpu_counts(spark.createDataFrame([("1.0", "C", "cpu=1,gres/gpu=2,mem=1,node=1")], alloc))
    jobs = assemble.gpu_counts(spark.createDataFrame(
        [("1", "C", "gres/gpu=8"), ("2", "C", "gres/gpu=4"), ("3", "C", None), ("4", "C", "cpu=1")], alloc), jobs=True)
    rows = spark.createDataFrame([(0, 1, "0"), (1, 2, "0"), (1, 3, "0"), (1, 4, "0")],
                                 "src int, job_id bigint, sub_job_id string")
    got = {r.job_id: r.ngpus for r in assemble.join_gpu(rows, steps.unionByName(jobs)).collect()}
    assert got == {1: 2.0, 2: 4.0, 3: None, 4: None}


# ---- labels --------------------------------------------------------------------

DICT = Dictionary.of(
    ("Casino", "casino", "MonteCarloMethods", "Fortran"),
    ("Vampire", "vampire", "MonteCarlo", "C++"),
    ("Mesh", "mesh|^grid", "Unstructured Grid", "C Fortran"),
    ("OpenSolver", r"open\.solver", "Grid", "C"),
    ("Solver", "solver$", "", ""),
    ("Python", "python", "Unknown", "Python"),
    ("a.out", r"a\.out", "Unknown", "Unknown"),
)


def test_last_definition_wins(spark):
    df = spark.createDataFrame([("casino_vampire",), ("xgrid",), ("grid1",), ("open.solver",), ("OPEN",), ("ab.out",)],
                               "exe_name string")
    got = {r.exe_name: r.software for r in classify.with_classes(df, DICT).collect()}
    assert got == {"casino_vampire": "Vampire", "xgrid": "Unknown", "grid1": "Mesh", "open.solver": "Solver",
                   "OPEN": "Unknown", "ab.out": "Unknown"}


def test_long_dictionaries_are_cut_into_several_expressions(spark):
    many = Dictionary.of(*[(f"n{i}", f"^e{i}$" if i % 2 else f"^e{i}x", "", "") for i in range(450)])
    df = spark.createDataFrame([("e449",), ("e0x",), ("e200x",), ("zzz",)], "exe_name string")
    got = {r.exe_name: r.software for r in classify.with_classes(df, many).collect()}
    assert got == {"e449": "n449", "e0x": "n0", "e200x": "n200", "zzz": "Unknown"}


def facts_of(spark, rows):
    return spark.createDataFrame(
        [(0, i, "0", exe, user, "p", 3600.0 * use, 1.0, 1.0, 1.0) for i, (exe, user, use) in enumerate(rows)],
        "src int, job_id bigint, sub_job_id string, exe_name string, user_name string, project_id string, "
        "use_s double, energy_j double, cores double, nodes double")


SHARED = UsageConfig(shared_node=True)
ENERGY = UsageConfig(family="energy")


def jobs_by_label(table, column):
    return {r[column]: r["Jobs"] for r in table.collect()}


def test_motif_words_are_matched_inside_values(spark):
    facts = facts_of(spark, [("casino", "u", 1), ("vampire", "u", 1), ("mesh", "u", 1), ("open.solver1", "u", 1),
                             ("solver", "u", 1), ("zzz", "u", 1)])
    got = jobs_by_label(analyses.report(facts, "MotifSize", SHARED, dictionary=DICT), "Motif")
    assert got == {"MonteCarloMethods": 1, "MonteCarlo": 2, "Unstructured": 1, "Grid": 2, "Unknown": 1, "Overall": 6}


def test_motif_words_must_occur_in_the_data(spark):
    facts = facts_of(spark, [("casino", "u", 1)])
    got = jobs_by_label(analyses.report(facts, "MotifSize", SHARED, dictionary=DICT), "Motif")
    assert got == {"MonteCarloMethods": 1, "Overall": 1}


def test_languages_are_compared_whole(spark):
    facts = facts_of(spark, [("casino", "u", 1), ("mesh", "u", 1), ("solver", "u", 1), ("zzz", "u", 1)])
    got = jobs_by_label(analyses.report(facts, "LangSize", SHARED, dictionary=DICT), "Language")
    assert got == {"Fortran": 1, "Unknown": 1, "Overall": 4}


def test_energy_software_is_matched_inside_names(spark):
    facts = facts_of(spark, [("solver", "u", 1), ("open.solver1", "u", 1), ("zzz", "u", 1)])
    got = jobs_by_label(analyses.report(facts, "CodeSize", ENERGY, dictionary=DICT), "Software")
    assert got == {"Solver": 2, "OpenSolver": 1, "Unidentified": 1, "Overall": 3}


def test_energy_areas_are_matched_inside_names(spark):
    facts = facts_of(spark, [("x", "u", 1)])
    areas = spark.createDataFrame([("p", "Physics of Plasma"), ("q", "Plasma"), ("r", "Chemistry")],
                                  "project_id string, area string")
    got = jobs_by_label(analyses.report(facts, "AreaSize", ENERGY, areas=areas), "Area")
    assert got == {"Physics of Plasma": 1, "Plasma": 1, "Overall": 1}


def test_anonymous_users_by_first_appearance(spark):
    facts = facts_of(spark, [("x", "zoe", 1), ("x", None, 1), ("x", "amy", 1), ("x", "zoe", 1)])
    later = facts.filter("false").unionByName(facts.filter("user_name = 'amy'").withColumns(
        {"src": F.lit(1), "job_id": F.lit(-5).cast("bigint"), "user_name": F.lit("bob")}))
    got = {r.user_name: r.anon_user for r in identity.anonymous_users(facts.unionByName(later)).collect()}
    assert got == {"zoe": "user0", None: "user1", "amy": "user2", "bob": "user3"}


def test_numbering_is_dense_across_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(8)
    got = identity.dense_index(df, [F.col("k").asc()], "n").collect()
    assert all(r.k == r.n for r in got) and len(got) == 1000


SPLIT_ROWS = [("a.out", "zoe", 1), ("python3", None, 1), ("python3", "amy", 1), ("mine", "amy", 50), ("tiny", "amy", .01)]


def test_user_split(spark):
    facts = facts_of(spark, SPLIT_ROWS)
    cfg = UsageConfig(shared_node=True, user_split=True)
    got = jobs_by_label(analyses.report(facts, "CodeSize", cfg, dictionary=DICT), "Software")
    assert got == {"a.out_user0": 1, "Python_user1": 1, "Python_user2": 1, "mine_user2": 1, "Unknown": 1, "Overall": 5}
    cfg = UsageConfig(shared_node=True, user_split=True, anonymise=False)
    got = jobs_by_label(analyses.report(facts, "CodeSize", cfg, dictionary=DICT), "Software")
    assert got == {"a.out_zoe": 1, "Python_amy": 1, "mine_amy": 1, "Unknown": 1, "Overall": 5}


def test_users_split_only_the_labels_that_carry_them(spark):
    """Rows of many users whose label carries no user are one group; those with a user are looked up by it."""
    rows = [("casino", f"u{i}", 1) for i in range(300)] + [("a.out", f"u{i}", 1) for i in range(5)] + [("a.out", None, 1), ("mine", "u1", 99), ("tiny", "u2", .01)]
    facts, cfg = facts_of(spark, rows), UsageConfig(shared_node=True, user_split=True)
    source = analyses.split_sources(facts, DICT, analyses.exe_use(facts), cfg)
    assert source.select("code", "big", "user").distinct().count() == 1 + 6 + 1 + 1
    assert source.filter("user IS NULL").count() == 300 + 1 + 1
    got = jobs_by_label(analyses.report(facts, "CodeSize", cfg, dictionary=DICT), "Software")
    assert sum(n for k, n in got.items() if k.startswith("a.out_")) == 6 and len([k for k in got if k.startswith("a.out_")]) == 6
    assert got["Overall"] == 308 and got["Unknown"] == 1


def uneven_facts(spark):
    """Users with many rows and with few, missing values everywhere, and names that make labels alike."""
    rng = random.Random(7)
    exes = ["a.out", "python3", "mine", "mine_x", "casino", "tiny", "zz"]
    users = ["big", "zoe", "amy", "x_zoe", None, "y", *(f"u{i}" for i in range(40))]
    rows = [(0, i % 70, str(i), rng.choice(exes), "big" if rng.random() < .4 else rng.choice(users), rng.choice(["z1", "z2", None]),
             rng.choice([None, 1.0, 2.0, 5.0, 16.0, 300.0]), rng.choice([None, 0.0, 90.0, 3600.0, 1e7, .25]), rng.choice([None, 5.0, 1e9]))
            for i in range(1500)]
    return spark.createDataFrame(rows, "src int, job_id bigint, sub_job_id string, exe_name string, user_name string, project_id string, "
                                       "cores double, use_s double, energy_j double")


@pytest.mark.parametrize("anonymise", [True, False])
def test_labels_apart_are_those_of_the_cube(spark, monkeypatch, anonymise):
    """A label has the same row whether its rows are few and lie together or go through the cube; equal texts are one label."""
    facts, cfg = uneven_facts(spark), UsageConfig(shared_node=True, user_split=True, anonymise=anonymise)
    codes = Dictionary.of(*[(d.name, d.pattern) for d in DICT.definitions], ("a.out_user3", "zz"), ("a.out_zoe", "tiny"), ("mine_user1", "nothing"))
    grouped = stats.pregrouped(facts, ["exe_name", "user_name", "project_id", "cores"], identity.first_seen())
    found = []
    for rows, keys in ((facts, lambda rows, key: HotKeys(key, {r[0]: 2 for r in rows.select(key).distinct().collect()})),
                       (facts, lambda rows, key: HotKeys(key, {})), (grouped, hot_keys)):
        monkeypatch.setattr(analyses, "hot_keys", keys)
        found.append(analyses.distribution_of(rows, analyses.USAGE_ANALYSES["CodeSize"], cfg, dictionary=codes).collect())
    first, *others = [sorted(map(tuple, rows), key=str) for rows in found]
    assert len({r[1] for r in first}) == len(first) > 60 and all(rows == first for rows in others)
    # Against a plain count: rows by label, and how many users and projects are among them.
    big = {"mine", "mine_x"}
    names = {None: None} | {r.user_name: r.anon_user if anonymise else r.user_name for r in identity.anonymous_users(facts).collect()}
    members = {}
    for r in facts.collect():
        who = names[r.user_name]
        base = {"a.out": "a.out", "python3": "Python", "casino": "Casino", "zz": "a.out_user3", "tiny": "a.out_zoe"}.get(r.exe_name, r.exe_name)
        carried = base in ("a.out", "Python") or base in big
        if carried and who is None:
            continue
        members.setdefault(f"{base}_{who}" if carried else base, []).append((r.user_name, r.project_id))
    at = {r["label"]: (r["jobs"], r["users"], r["projects"]) for r in found[1] if r["label"] != "Overall"}
    assert at == {k: (len(v), len({u for u, _ in v} - {None}), len({p for _, p in v} - {None})) for k, v in members.items()}


def test_user_split_matched_inside_names(spark):
    rows = [("python3", f"u{i:02d}", 1) for i in range(12)] + [("tiny", "u00", .01)]
    cfg = UsageConfig(family="energy", user_split=True)
    got = jobs_by_label(analyses.report(facts_of(spark, rows), "CodeSize", cfg, dictionary=DICT), "Software")
    # Python_user1 also collects Python_user10 and Python_user11.
    assert got["Python_user1"] == 3 and got["Python_user2"] == 1 and got["Unidentified"] == 1


def test_contained_values_needs_no_pairs(spark):
    df = spark.createDataFrame([("ab",), ("b",), ("abc",), (None,), ("",)], "v string")
    got = {(r.v, r.inner) for r in classify.contained_values(df, "v").collect()}
    assert got == {("ab", "ab"), ("ab", "b"), ("b", "b"), ("abc", "abc"), ("abc", "ab"), ("abc", "b")}


def test_report_columns(spark):
    facts = facts_of(spark, [("casino", "u", 1)])
    plain = analyses.report(facts, "CodeSize", SHARED, dictionary=DICT).columns
    assert plain == ["Software", "Min", "Q1", "Median", "Q3", "Max", "Jobs", "Nodeh", "PercentUse", "Users", "Projects"]
    web = analyses.report(facts, "CodeSize", UsageConfig(family="energy", web=True), dictionary=DICT).columns
    assert "Nodeh" not in web and "kWh" not in web and "PercentEnergy" in web


def test_boxes_of_top_applications(spark):
    rows = [("casino", "u", 1.5), ("casino", "u", 3.0), ("vampire", "u", .5), ("zzz", "u", .25)]
    facts = facts_of(spark, rows).withColumn("cores", F.when(F.col("use_s") > 6000, 64.0).otherwise(16.0))
    got = [(r.software, r.use, r.copies, r.q1, r["median"], r["mean"], r.whisker_low)
           for r in analyses.top_code_boxes(facts, SHARED, DICT).collect()]
    # One copy of 16 and three of 64; applications below one hour keep their place without a box.
    assert got == [("Casino", 4.5, 4, 52.0, 64.0, 52.0, 52.0), ("Vampire", .5, None, None, None, None, None),
                   ("Unknown", .25, None, None, None, None, None)]


# ---- roll-up and matrix ------------------------------------------------------------

def test_roll_up(spark):
    schema = "key string, kWh double, Nodeh double, Users int, Projects int"
    rows = [("Overall", 10., 100., 5, 3), ("A", 4., 60., 4, 2), ("Overall", 30., 300., 7, 2), ("A", 2., 40., 2, 2),
            ("B", None, 20., 1, 1)]
    got = {r.key: r for r in rollup.combine_summaries(spark.createDataFrame(rows, schema)).collect()}
    assert (got["A"].Nodeh, got["A"].Users_min, got["A"].Users_max, got["A"].PercentUse) == (100., 2, 4, 25.)
    assert (got["B"].kWh, got["B"].PercentEnergy) == (0., 0.)
    alone = rollup.combine_summaries(spark.createDataFrame(rows[1:2], schema)).collect()
    assert alone[0].PercentUse is None


def test_matrix_masks_cells_without_runs(spark):
    rows = spark.createDataFrame(
        [("f", 0, 1, "1h", "1", 5, 5, 100., "0:1:0", .5), ("f", 0, 2, "1h", "2", 3, 0, 0., "0:2:0", .9),
         ("f", 0, 3, "1h", "3-4", 2, 2, 95., "0:3:0", .1), ("f", 0, 4, "1h", "3-4", 2, 1, 91., "0:4:0", .2)],
        "file_path string, block int, line int, runtime string, size string, submitted bigint, ran bigint, "
        "usage double, wait string, coefficient double")
    blocks = rows.select("file_path", "block", "runtime").distinct()
    cells = {r.size: r for r in matrix.hot(matrix.dense(rows, blocks)).collect()}
    assert len(cells) == 14
    assert (cells["1"].hot, cells["2"].usage, cells["2"].submitted) == (True, None, 3)
    assert (cells["3-4"].usage, cells["3-4"].hot) == (91., True)        # the last row of a size counts
    assert (cells["5-8"].wait, cells["5-8"].ran, cells["5-8"].hot) == ("0:0:0", 0, False)


def test_matrix_keeps_unlisted_sizes_and_empty_blocks(spark):
    schema = ("file_path string, block int, line int, runtime string, size string, submitted bigint, ran bigint, "
              "usage double, wait string, coefficient double")
    rows = spark.createDataFrame([("f", 0, 1, "1h", "7", 5, 5, 100., "0:1:0", .5), ("g", 0, 1, "1h", "1", 5, 5, 9., "0:1:0", .5)], schema)
    blocks = spark.createDataFrame([("f", 0, "1h"), ("f", 1, "2h"), ("g", 0, "1h")], "file_path string, block int, runtime string")
    cells = matrix.dense(rows, blocks).collect()
    assert {(r.file_path, r.block): n for r in cells for n in [sum(x.file_path == r.file_path and x.block == r.block for x in cells)]} == {
        ("f", 0): 15, ("f", 1): 15, ("g", 0): 14}
    assert [(r.size_index, r.usage) for r in cells if (r.file_path, r.block, r.size) == ("f", 0, "7")] == [(14, 100.)]
    with pytest.raises(Exception, match="no column for size 7"):
        matrix.pivoted(matrix.dense(rows, blocks), "usage").collect()


def test_long_values_inside_each_other(spark):
    """Values of 500 lengths up to 2,000 characters, against plain search."""
    import random
    rng = random.Random(4)
    whole = "".join(rng.choice("ab é") for _ in range(2_000))
    values = {whole[a: a + n] for n in range(4, 2_004, 4) for a in [rng.randrange(0, 2_001 - min(n, 2_000))]}
    values |= {"a", "ab", "é", "ab é", "x", "user1", "user10", "user100", "Python_user1", "Python_user10", "a" * 7, "a" * 8, "a" * 9, "a" * 40}
    rows = spark.createDataFrame([(v,) for v in [*values, None, "", "user1"]], "v string")
    found = [(r["v"], r["inner"]) for r in classify.contained_values(rows, "v").collect()]
    assert sorted(found) == sorted((v, w) for v in values for w in values if w in v)
