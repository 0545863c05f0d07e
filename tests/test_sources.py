"""Readers and writers on hand-written files."""

import random

import pytest

from jobuse.session import shared_dir
from jobuse.sources import definitions, dumps, report, sinks


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_steps_keep_commas_and_quotes(spark, tmp_path):
    path = write(tmp_path, "steps.dat",
                 '7.0::my "job", v2::ann::z19-x::2::256::60::COMPLETED::100::1K::1K::2000000\n'
                 "7.1::None::::z19::1::::5::FAILED::::::::\n")
    a, b = dumps.with_job_ids(dumps.read_steps(spark, path)).orderBy("sub_job_id").collect()
    assert (a.job_id, a.sub_job_id, a.exe_name, a.nodes) == (7, "0", 'my "job", v2', "2")
    assert (b.exe_name, b.user_name, b.ntasks, b.energy_j) == (None, None, None, None)


def test_user_map_last_entry_wins(spark, tmp_path):
    path = write(tmp_path, "users.dat", "JobID,User\n1, ann\n2, bob\n3\n1, cat\nx, dan\n")
    assert {r.job_id: r.user_name for r in dumps.read_user_map(spark, path).collect()} == {1: "cat", 2: "bob"}


def test_user_map_order_holds_across_splits(spark, tmp_path):
    lines = "".join(f"{i % 50}, user{i}\n" for i in range(20_000))
    path = write(tmp_path, "users.dat", "JobID,User\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        table = dumps.read_user_map(spark, path)
        assert {r.job_id: r.user_name for r in table.collect()} == {
            i: f"user{19_950 + i}" for i in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_step_exe_map(spark, tmp_path):
    path = write(tmp_path, "exe.dat", "5.0,first\n6.0\n5.0,last\n7.0,x\n")
    assert {r.job_id: r.exe_name for r in dumps.read_step_exe(spark, path).collect()} == {5: "last", 7: "x"}
    assert dumps.read_step_exe(spark, path, header=True).count() == 2


def test_areas(spark, tmp_path):
    path = write(tmp_path, "areas.csv", 'Project,Area\nz19, "Physics, Plasma"\ne01, Chemistry\nz19, Physics\nlone\n')
    got = {r.project_id: r.area for r in dumps.read_areas(spark, path).collect()}
    assert got == {"z19": "Physics", "e01": "Chemistry"}


def test_gpu_allocations(spark, tmp_path):
    path = write(tmp_path, "gpu.dat", "1.0,COMPLETED,cpu=1,gres/gpu=2,mem=1G,node=1\n2,FAILED,None\n3,FAILED\n")
    got = {r.job_id_raw: r.allocation for r in dumps.read_gpu_alloc(spark, path).collect()}
    assert got == {"1.0": "cpu=1,gres/gpu=2,mem=1G,node=1", "2": None, "3": None}


def test_usage_file_names_go_by_position(spark, tmp_path):
    path = write(tmp_path, "usage.csv", "a,b,c,d,e,f,g,h,i,j,k,l,m\n"
                 '1,"x, ""y""",ann,z19,1,128,60,COMPLETED,5,1K,1K,2000000,0\n')
    r = dumps.read_usage(spark, path).first()
    assert (r.job_id, r.exe_name, r.sub_job_id, r.cpu_freq) == ("1", 'x, "y"', "0", "2000000")


def test_energy_jobs_in_both_forms(spark, tmp_path):
    raw = write(tmp_path, "raw.dat", "9::x::ann::z19-a::1::60::COMPLETED::100\n")
    merged = write(tmp_path, "merged.csv", "JobID,ExeName,User,Account,Nodes,Runtime,State,Energy\n"
                   "9,x,ann,z19-a,1,60,COMPLETED,100\n")
    assert dumps.read_energy_jobs(spark, raw).collect() == dumps.read_energy_jobs(spark, merged, merged=True).collect()


CODE = """# a comment
[code info]
name: {name}
regexp: {pattern}

[metadata]
primary language: {language}
version:          95

academic license = Free
Commercial License: Fee Payment

code type: {motif}

research area:
parallel-model: MPI
"""


def test_definitions(spark, tmp_path):
    write(tmp_path, "b.code", CODE.format(name="Second", pattern=r"^two[a-z]{2}\.x|b:c", language="C++", motif="Grid  Other"))
    write(tmp_path, "a.code", CODE.format(name="First App", pattern="one=1", language="Fortran", motif=""))
    write(tmp_path, "c.txt", "not a definition")
    table = definitions.read_code_defs(spark, str(tmp_path))
    rows = table.orderBy("ord").collect()
    assert [(r.ord, r.name, r.pattern, r.language, r.motif, r.area) for r in rows] == [
        (0, "First App", "one=1", "Fortran", "", ""),
        (1, "Second", r"^two[a-z]{2}\.x|b:c", "C++", "Grid  Other", "")]
    assert (rows[0].version, rows[0].academic_license, rows[0].commercial_license) == ("95", "Free", "Fee Payment")
    loaded = definitions.Dictionary.from_table(table)
    assert loaded.names == ["First App", "Second"]


def test_dictionaries_of_any_length(spark):
    table = spark.range(12_000).selectExpr("int(id) AS ord", "concat('n', id) AS name", "'p' AS pattern", "'' AS motif", "'' AS language")
    assert definitions.Dictionary.from_table(table).names == [f"n{k}" for k in range(12_000)]


REPORT = """heading
1,2,3,4,5,6,7
Runtime: 0-3 hours
Nodes,Submitted,Ran,Usage
1,10,9,100.5,x,0:1:2,0.75
3-4,2,0,0.0,x,0:0:0,0.0
,12,9
between the blocks
Runtime: 3-6 hours
Nodes,Submitted,Ran,Usage
2,1,1,7.25,x,1:0:0,1.0
,1,1
"""


def test_report(spark, tmp_path):
    path = write(tmp_path, "report.txt", REPORT)
    rows = report.read_report(spark, path).orderBy("block", "line").collect()
    assert [(r.block, r.runtime, r["size"], r.submitted, r.ran, r.usage, r.wait, r.coefficient) for r in rows] == [
        (0, "0-3", "1", 10, 9, 100.5, "0:1:2", 0.75), (0, "0-3", "3-4", 2, 0, 0.0, "0:0:0", 0.0),
        (1, "3-6", "2", 1, 1, 7.25, "1:0:0", 1.0)]
    assert [r.runtime for r in report.report_blocks(spark, path).orderBy("block").collect()] == ["0-3", "3-6"]


def test_a_report_is_read_in_many_splits(spark, tmp_path):
    """Blocks begin, go on and end in any split; the same rows come from one split and from hundreds."""
    rng = random.Random(5)
    text, expected, block = "heading\n", [], -1
    for block in range(60):
        text += f"Runtime: {block}h or so\nNodes,Submitted\n"
        n = rng.choice([0, 0, 1, 2, 5, 400])
        for k in range(n):
            text += f"{k},{k},{block},0.5,x,0:0:{k},0.25\n" + rng.choice(["", "", "\n"])
        expected += [(block, f"{block}h", str(k), k, block) for k in range(n)]
        text += rng.choice(["", ",9,9\nnot,a,row\n"])
    write(tmp_path, "a.txt", text)
    write(tmp_path, "b.txt", "no block\n1,2\n")
    write(tmp_path, "c.txt", "")
    write(tmp_path, "d.txt", REPORT.replace("\n", "\r\n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128MB", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lines = report.numbered_lines(spark, str(tmp_path))
            assert size == "128MB" or lines.rdd.getNumPartitions() > 50
            rows = report.read_report(spark, str(tmp_path)).collect()
            blocks = report.report_blocks(spark, str(tmp_path)).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        of_a = [r for r in rows if r.file_path.endswith("a.txt")]
        assert [(r.block, r.runtime, r["size"], r.submitted, r.ran) for r in sorted(of_a, key=lambda r: (r.block, r.line))] == expected
        assert sorted((r.block, r.runtime) for r in blocks if r.file_path.endswith("a.txt")) == [(k, f"{k}h") for k in range(60)]
        assert {(r.block, r["size"]) for r in rows if r.file_path.endswith("d.txt")} == {(0, "1"), (0, "3-4"), (1, "2")}
        assert len(rows) == len(expected) + 3 and len(blocks) == 62


def test_summaries_by_pattern(spark, tmp_path):
    for name, rows in {"jan_CodeSize.csv": "A,1.5,2", "feb_CodeSize.csv": "A,2.5,3", "jan_AreaSize.csv": "Z,9,9"}.items():
        write(tmp_path, name, f"Software,Nodeh,Users\n{rows}\n")
    got = dumps.read_summaries(spark, str(tmp_path), " CodeSize ", key="Software").collect()
    assert sorted((r.Software, r.Nodeh, r.Users) for r in got) == [("A", 1.5, 2.0), ("A", 2.5, 3.0)]


def test_results_are_printed_with_one_decimal(spark, tmp_path):
    df = spark.createDataFrame([("a", 2.25, 1), ("b", 2.75, 2), ("c", None, 3), ("d", 0.06, 4)],
                               "Software string, Q1 double, Jobs int")
    path = sinks.write_result(df, str(tmp_path), "use", "CodeSize", weighted=True)
    assert path.endswith("use_CodeSize_weighted.csv")
    got = {r.Software: (r.Q1, r.Jobs) for r in spark.read.csv(path, header=True).collect()}
    assert got == {"a": ("2.2", "1"), "b": ("2.8", "2"), "c": (None, "3"), "d": ("0.1", "4")}


def test_merged_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, 'b, "c"')], "job_id bigint, exe_name string")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.write_merged(df, path, fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else spark.read.csv(
            path, header=True, escape='"', schema="job_id bigint, exe_name string")
        assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, 'b, "c"')]


def test_shared_dir_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_guard(spark):
    assert not sinks.has_rows(spark.range(0)) and sinks.has_rows(spark.range(1))


def test_bad_report_rows_name_their_place(spark, tmp_path):
    for bad in ("1,10", "1,x,9,100.5,x,0:1:2,0.75", "1,10,9,100.5,x,0:1:2,"):
        write(tmp_path, "bad.txt", f"Runtime: 1h\nNodes,x\n{bad}\n,1\n")
        with pytest.raises(Exception, match=f"bad.txt, block 0, line 2: {bad}"):
            report.read_report(spark, f"{tmp_path}/bad.txt").collect()


def test_maps_take_the_last_entry_even_if_missing(spark, tmp_path):
    write(tmp_path, "users", "id,user\n1,ann\n1, None\n2,bob\n2\n3,eve\n3,\n4,old\n4,new,more\n5,nan\n6,NA\n6,kim\nx,no\n")
    got = {r.job_id: r.user_name for r in dumps.read_user_map(spark, f"{tmp_path}/users").collect()}
    assert got == {1: None, 2: "bob", 3: None, 4: "new", 5: None, 6: "kim"}
    write(tmp_path, "exes", "1.0, a\n1.0,None\n2.3, b\n2.3\n")
    assert {r.job_id: r.exe_name for r in dumps.read_step_exe(spark, f"{tmp_path}/exes").collect()} == {1: None, 2: "b"}


def test_summaries_join_by_column_name(spark, tmp_path):
    write(tmp_path, "a_X.csv", "Software,Nodeh,kWh,Users\nApp,1.5,2,3\n")
    write(tmp_path, "b_X.csv", "kWh,Other,Software,Nodeh\n5,z,App,4\n")
    got = sorted((r.Software, r.Nodeh, r.kWh, r.Users) for r in dumps.read_summaries(spark, str(tmp_path), "X", key="Software").collect())
    assert got == [("App", 1.5, 2.0, 3.0), ("App", 4.0, 5.0, None)] or sorted(got, key=str) == sorted([("App", 1.5, 2.0, 3.0), ("App", 4.0, 5.0, None)], key=str)
    write(tmp_path, "c_X.csv", "Name,Nodeh\nApp,4\n")
    with pytest.raises(ValueError):
        dumps.read_summaries(spark, str(tmp_path), "X", key="Software")
