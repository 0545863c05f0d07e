"""The dictionary as a table of words, against one search per name and pattern."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from jobuse.operators import classify, joins, wordindex
from jobuse.sources.definitions import Dictionary

DEFINITIONS = "ord int, name string, pattern string, motif string, language string"

PATTERNS = [
    "gear", "^gear", "gear$", "^gear$", "ge?ar", "gea?r|bolt", "ab*c", "ab+c", "a.c", "a.*c$", "^.*x", "gear|", "x|^y", "(gear|bolt)x",
    "[gb]ol", r"\d", "(?i)GEAR", "longer_than_eight", "longer_than_nine?s", "er_than_eigh", "a??b", "a+?b", "ß.ü", "ñ", "a b", ".", "$",
    "b{2}", "q.?[0-9]", "ever_than|t_a_w", "#1", "-", "_", "aa"]


def last_found(name, patterns):
    if name is None:
        return None
    hits = [k for k, p in enumerate(patterns) if p is not None and re.search(p, name)]
    return hits[-1] if hits else None


def names_for(rng):
    pieces = ["gear", "bolt", "a", "b", "c", "x", "y", "q7", "longer_than_eight", "longer_than_nin", "ß1ü", "ñ", " ", "_", "#1", "GEAR", "z"]
    return [None, "", "a"] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 5))) for _ in range(300)]


@pytest.mark.parametrize("seed", range(4))
def test_the_last_definition_found_wins(spark, seed):
    rng = random.Random(seed)
    patterns = rng.sample(PATTERNS, 12) + [None]
    if seed == 1:
        patterns.insert(0, "")                          # found everywhere
    rng.shuffle(patterns)
    names = names_for(rng)
    table = spark.createDataFrame([(k, f"d{k}", p, None if k % 3 else "m", "l") for k, p in enumerate(patterns)], DEFINITIONS)
    df = spark.createDataFrame([(n, k, "old") for k, n in enumerate(names)], "exe_name string, k int, motif string")
    for family in ("usage", "energy"):
        got = {r.k: r for r in wordindex.with_classes_by_words(df, table, family).collect()}
        assert len(got) == len(names)
        for k, name in enumerate(names):
            at = last_found(name, patterns)
            missing = None if family == "energy" else "Unknown"
            assert got[k].software == (missing if at is None else f"d{at}"), (name, patterns)
            assert got[k].motif == ("Unknown" if at is None else "" if at % 3 else "m")
            assert ("language" in got[k]) == (family == "usage")


def test_agrees_with_the_dictionary_in_the_plan(spark):
    rows = [(k, f"d{k}", p, "m", "l") for k, p in enumerate(PATTERNS[:15])]
    df = spark.createDataFrame([(n,) for n in names_for(random.Random(9))], "exe_name string")
    table = spark.createDataFrame(rows, DEFINITIONS)
    by_case = classify.with_classes(df, Dictionary.of(*[r[1:] for r in rows])).collect()
    assert sorted(by_case, key=str) == sorted(wordindex.with_classes_by_words(df, table).collect(), key=str)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DEFINITIONS), spark.createDataFrame([(0, "d", "x", "m", "l")], DEFINITIONS)
    df = spark.createDataFrame([("x",), (None,)], "exe_name string")
    assert wordindex.last_definitions(df, none).count() == 0
    assert wordindex.last_definitions(df.limit(0), some).count() == 0
    assert {r.software for r in wordindex.with_classes_by_words(df, none).collect()} == {"Unknown"}


def plan_length(df) -> int:
    return len(re.sub(r"\d+", "", df._jdf.queryExecution().optimizedPlan().toString()))


def test_many_definitions_make_no_larger_plan(spark):
    """20,000 definitions tag 100,000 names; the parts of their words that all share do not count."""
    word = F.concat(F.lit("application-"), F.sha2(F.col("id").cast("string"), 256).substr(1, 10))
    definitions = spark.range(20000).select(F.col("id").cast("int").alias("ord"), word.alias("name"),
                                            F.concat(F.lit("^"), word, F.lit("|"), word).alias("pattern"),
                                            F.lit("m").alias("motif"), F.lit("l").alias("language"))
    names = spark.range(100000).select(F.concat(F.lit("/opt/"), F.lit("application-"),
                                                F.sha2((F.col("id") % 40000).cast("string"), 256).substr(1, 10), F.lit("-"), "id").alias("exe_name"))
    start = time.time()
    tagged = wordindex.with_classes_by_words(names, definitions)
    assert tagged.where("software <> 'Unknown'").count() == 60000
    assert time.time() - start < 90
    few = wordindex.with_classes_by_words(names.limit(10), definitions.limit(10))
    assert abs(plan_length(tagged.select("software")) - plan_length(few.select("software"))) < 400


def test_a_long_dictionary_is_not_broadcast(spark):
    """150,000 names of one form: a file of a megabyte or two, but rows that fill a small driver."""
    rows = spark.range(150000).select(F.col("id").cast("int").alias("ord"), F.format_string("user %d", "id").alias("name"),
                                      F.format_string("Customer#%09d", "id").alias("pattern"), F.lit("m").alias("motif"), F.lit("l").alias("language"))
    definitions = wordindex.written(rows)
    names = spark.range(0, 300000, 300).select(F.format_string("a/Customer#%09d", "id").alias("exe_name"))
    tagged = wordindex.with_classes_by_words(names, definitions)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert tagged.where("software = concat('user ', cast(right(exe_name, 9) AS int))").count() == 500
    assert tagged.where("software = 'Unknown'").count() == 500


def test_the_filter_of_pieces_loses_none(spark, monkeypatch):
    rows = [(k, f"d{k}", p, "m", "l") for k, p in enumerate(PATTERNS)]
    df = spark.createDataFrame([(n,) for n in names_for(random.Random(5))], "exe_name string")
    table = spark.createDataFrame(rows, DEFINITIONS)
    expected = sorted(wordindex.with_classes_by_words(df, table).collect(), key=str)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    for bits in (1 << 25, 64):
        monkeypatch.setattr(wordindex, "PIECE_BITS", bits)
        assert sorted(wordindex.with_classes_by_words(df, table).collect(), key=str) == expected
