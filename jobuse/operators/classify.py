"""Tagging executables with application, motif and language.

The dictionary is part of the plan: one CASE over literal patterns, tried from
the last definition to the first, so each pattern is compiled once per task and
rows are tagged where they are, without a join or a shuffle.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.session import written
from jobuse.sources.definitions import Dictionary

UNKNOWN = "Unknown"
BRANCHES_PER_CASE = 200

# Alternatives without any special character, each perhaps tied to the start.
PLAIN_WORDS = re.compile(r"\^?[\w \-/]+(\|\^?[\w \-/]+)*", re.ASCII)


def found(exe: Column, pattern: str) -> Column:
    """Whether a pattern occurs in a name. Plain words are searched as bytes,
    which spares decoding the name for every pattern."""
    if not PLAIN_WORDS.fullmatch(pattern):
        return exe.rlike(pattern)
    words = [exe.startswith(w[1:]) if w.startswith("^") else exe.contains(w)
             for w in pattern.split("|")]
    return reduce(lambda a, b: a | b, words)


def definition_index(exe: Column, dictionary: Dictionary) -> Column:
    """Position of the last definition whose pattern is found in ``exe``, or NULL."""
    numbered = list(enumerate(dictionary.definitions))[::-1]
    cases = []
    for start in range(0, len(numbered), BRANCHES_PER_CASE):
        case = None
        for i, d in numbered[start:start + BRANCHES_PER_CASE]:
            hit = found(exe, d.pattern)
            case = F.when(hit, F.lit(i)) if case is None else case.when(hit, F.lit(i))
        cases.append(case)
    return F.coalesce(*cases) if cases else F.lit(None).cast("int")


def pick(index: Column, values: list, default) -> Column:
    """``values[index]``, or ``default`` where the index is NULL."""
    missing = F.lit(default) if not isinstance(default, Column) else default
    if not values:
        return missing
    table = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
    return F.when(index.isNull(), missing).otherwise(F.get(table, index))


def with_classes(df: DataFrame, dictionary: Dictionary, family: str = "usage",
                 exe: str = "exe_name") -> DataFrame:
    """Add ``software``, ``motif`` and (usage family) ``language`` columns."""
    defs = dictionary.definitions
    tagged = df.withColumn("_def", definition_index(F.col(exe), dictionary))
    index = F.col("_def")
    unhit = F.lit(None).cast("string") if family == "energy" else F.lit(UNKNOWN)
    columns = {
        "software": pick(index, [d.name for d in defs], unhit),
        "motif": pick(index, [d.motif for d in defs], UNKNOWN),
    }
    if family != "energy":
        columns["language"] = pick(index, [d.language for d in defs], UNKNOWN)
    return tagged.withColumns(columns).drop("_def")


def tokens(text: Column) -> Column:
    """Words of a space-separated text; none for empty text."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")


def distinct_tokens(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(column).distinct().select(F.explode(tokens(F.col(column))).alias(name)).distinct()


def substrings(text: Column, lengths: Column) -> Column:
    """The distinct pieces of a text that have one of some lengths."""
    n = F.length(text)
    pieces = F.transform(
        F.filter(lengths, lambda k: (k > 0) & (k <= n)),
        lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(text, i, k)),
    )
    return F.array_distinct(F.flatten(pieces))


PROBE = 8      # length of the piece that a longer value is looked for by


def contained_values(values: DataFrame, column: str) -> DataFrame:
    """For each distinct value, the distinct values that occur inside it (as ``inner``).

    Pieces are joined on equality; no value is compared with all others. A value
    of ``PROBE`` characters or more is looked for by one of its pieces of that
    length, the one that fewest values have, and what is found is verified. Values
    are therefore cut into pieces of that one length, and of the shorter lengths
    that shorter values have: at most ``PROBE`` for each character.
    """
    distinct = written(values.select(column).filter(F.col(column).isNotNull() & (F.col(column) != "")).distinct())
    length = F.length(column)
    few = distinct.filter(length < PROBE).agg(F.collect_set(length))        # fewer than PROBE lengths
    short = distinct.withColumn("_lengths", few.scalar()).select(column, F.explode(substrings(F.col(column), F.col("_lengths"))).alias("inner"))
    short = short.join(distinct.filter(length < PROBE).select(F.col(column).alias("inner")), "inner")
    grams = distinct.select(column, F.explode(substrings(F.col(column), F.array(F.lit(PROBE)))).alias("_gram"))
    shared = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = grams.join(shared, "_gram").groupBy(F.col(column).alias("inner")).agg(F.min(F.struct("_n", "_gram")).alias("_probe"))
    found = grams.join(rarest.select("inner", F.col("_probe._gram").alias("_gram")), "_gram").filter(F.col(column).contains(F.col("inner")))
    return short.select("inner", column).unionByName(found.select("inner", column))
