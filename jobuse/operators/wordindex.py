"""Tagging distinct names with a dictionary of any size, through an index of its words.

A definition's pattern is split into alternatives. Each alternative without groups,
classes and escapes has a literal word that every match contains; names can only
match where that word occurs in them. A word is looked for by one piece of at most
``PROBE`` characters, the one that fewest other words have: pieces of names and of
words are joined on equality, and what is found is verified by the alternative
itself. So the work follows the names and the hits, not names times definitions,
and the plan is the same for any number of definitions - but for long dictionaries,
which are never broadcast: there pieces of names that are no word's piece are
dropped by a filter of fixed size before the others are shuffled.

Patterns that cannot be split (groups, classes, escapes, alternatives without a
literal) go into one expression that is tried on the distinct names, as
``classify.definition_index`` does for small dictionaries. Of the definitions found,
the last one wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.operators import joins
from jobuse.operators.classify import PROBE, UNKNOWN, definition_index, substrings
from jobuse.session import removed, stored, written
from jobuse.sources.definitions import Dictionary

SPECIAL = r"[()\[\]{}\\]"
# A literal may be left out where one of these follows it.
OPTIONAL = r"[^.^$][?*]"

PIECE_BITS = 1 << 25    # of the filter for pieces, 4 MB


def alternatives(definitions: DataFrame) -> DataFrame:
    """``ord, part, word`` of each alternative; ``word`` is its longest literal, empty if it has none.

    A pattern with special characters is one alternative without a word.
    """
    whole = F.col("pattern").rlike(SPECIAL)
    parts = F.when(whole, F.array("pattern")).otherwise(F.split("pattern", r"\|", -1))
    words = F.split(F.regexp_replace(F.col("part"), OPTIONAL, "."), r"[.^$?*+]+")
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))["word"]
    return definitions.select("ord", "pattern", F.explode(parts).alias("part")).select(
        "ord", "pattern", "part", F.when(F.col("pattern").rlike(SPECIAL), F.lit("")).otherwise(longest).alias("word"))


def probes(words: DataFrame, rows: int) -> DataFrame:
    """``word, piece``: the piece of ``PROBE`` characters (shorter words: the word) that fewest words have.

    ``rows`` is at least the number of words.
    """
    cut = words.select("word", F.explode(substrings(F.col("word"), F.array(F.least(F.length("word"), F.lit(PROBE))))).alias("piece"))
    shared = cut.groupBy("piece").agg(F.count("*").alias("n"))
    rarest = cut.join(joins.by_rows(shared, rows), "piece").groupBy("word").agg(F.min(F.struct("n", "piece")).alias("rarest"))
    return rarest.select("word", F.col("rarest.piece").alias("piece"))


def _bit(piece: str) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(PIECE_BITS))


def piece_filter(index: DataFrame) -> DataFrame:
    """One row: ``PIECE_BITS`` bits in an array of longs, with the bit of each piece set."""
    bit = _bit("piece")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
    given = index.select(F.shiftright(bit, 6).alias("at"), one.alias("bits"))
    empty = index.sparkSession.range(PIECE_BITS // 64).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("bits"))
    longs = given.unionByName(empty).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return longs.agg(F.sort_array(F.collect_list(F.struct("at", "bits")))["bits"].alias("bits"))


def may_be_looked_for(piece: str, bits: Column) -> Column:
    """Whether a piece may be one of those in ``bits``: never false for one that is."""
    return F.getbit(F.get(bits, F.shiftright(_bit(piece), 6).cast("int")), _bit(piece).bitwiseAND(F.lit(63)).cast("int")) == 1


def last_definitions(names: DataFrame, definitions: DataFrame, exe: str = "exe_name") -> DataFrame:
    """``exe, ord`` of the last definition found in each distinct name; names without one are left out.

    ``definitions`` has ``ord, pattern`` (and more); an empty pattern is found in
    every name, a null one in none. Null names have none. The result is a written
    table; the tables in between are removed.
    """
    with (stored(names.select(F.col(exe).alias("name")).filter(F.col("name").isNotNull()).distinct()) as distinct,
          stored(alternatives(definitions.filter(F.col("pattern").isNotNull()))) as parts):
        worded, rows = parts.filter("word <> ''"), parts.count()
        lengths = worded.agg(F.collect_set(F.least(F.length("word"), F.lit(PROBE))))        # PROBE lengths at most
        cut = distinct.withColumn("lengths", lengths.scalar()).select(
            "name", F.explode(substrings(F.col("name"), F.col("lengths"))).alias("piece"))
        index = written(worded.join(joins.by_rows(probes(worded.select("word").distinct(), rows), rows), "word")
                        .select("ord", "part", "word", "piece"))
        if rows > joins.BROADCAST_ROWS:
            cut = cut.filter(may_be_looked_for("piece", piece_filter(index).scalar()))
        hit = F.when(F.col("part") == F.col("word"), F.lit(True)).otherwise(F.expr("name RLIKE part"))
        found = cut.join(joins.by_rows(index, rows), "piece").filter(F.col("name").contains(F.col("word")) & hit).select("name", "ord")
        rest = parts.filter("word = ''").select("ord", "pattern").distinct().orderBy("ord").collect()
        if rest:
            others = Dictionary.of(*[(str(r["ord"]), r["pattern"]) for r in rest])
            place = F.get(F.array(*[F.lit(r["ord"]) for r in rest]), definition_index(F.col("name"), others))
            found = found.unionByName(distinct.select("name", place.alias("ord")).filter(F.col("ord").isNotNull()))
        table = written(found.groupBy(F.col("name").alias(exe)).agg(F.max("ord").alias("ord")))
        removed(index)
        return table


def with_classes_by_words(df: DataFrame, definitions: DataFrame, family: str = "usage", exe: str = "exe_name") -> DataFrame:
    """``classify.with_classes`` for a dictionary that stays a table (``ord, name, pattern, motif, language``).

    Names are tagged once each; rows then look their name up, by broadcast where
    the tags are below Spark's threshold and ``joins.BROADCAST_ROWS``.
    """
    columns = {"software": "name", "motif": "motif"} | ({} if family == "energy" else {"language": "language"})
    rows = df.drop(*columns)
    found = last_definitions(rows, definitions, exe)
    size = found.count()
    tags = found.withColumnRenamed(exe, "_exe").join(joins.by_rows(definitions, definitions.count()), "ord").select("_exe", *[
        F.col(c).alias(new) if c == "name" else F.coalesce(F.col(c), F.lit("")).alias(new) for new, c in columns.items()])
    tagged = rows.join(joins.by_rows(tags, size), F.col(exe) == F.col("_exe"), "left")
    found = F.col("_exe").isNotNull()
    return tagged.select(*rows.columns, *[
        F.col(new) if family == "energy" and new == "software" else F.when(found, F.col(new)).otherwise(F.lit(UNKNOWN)).alias(new)
        for new in columns])
