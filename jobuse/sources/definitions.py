"""Application dictionary: one INI file per application."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Section and key of each field in a definition file.
FIELDS = {
    "name": ("code info", "name"),
    "pattern": ("code info", "regexp"),
    "language": ("metadata", "primary language"),
    "version": ("metadata", "version"),
    "academic_license": ("metadata", "academic license"),
    "commercial_license": ("metadata", "commercial license"),
    "motif": ("metadata", "code type"),
    "area": ("metadata", "research area"),
}


def _field(section: str, key: str) -> Column:
    body = F.regexp_extract(F.col("value"), rf"(?ims)^\[{section}\][ \t]*$(.*?)(?=^\[|\z)", 1)
    return F.trim(F.regexp_extract(
        body, rf"(?im)^{key}[ \t]*[:=][ \t]*(.*?)[ \t\r]*$", 1))


def read_code_defs(spark: SparkSession, path: str, glob: str = "*.code") -> DataFrame:
    """Definition files as a table, numbered in file-name order.

    Where patterns overlap, the last definition in that order wins.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    rows = files.select(
        F.col("_metadata.file_path").alias("file_path"),
        *[_field(*where).alias(name) for name, where in FIELDS.items()],
    )
    # The window runs over files of a hand-written dictionary, not over facts.
    ordered = Window.orderBy("file_path")
    return rows.withColumn("ord", (F.row_number().over(ordered) - 1).cast("int")).select(
        "ord", *FIELDS)


@dataclass(frozen=True)
class Definition:
    name: str
    pattern: str
    motif: str = "Unknown"
    language: str = "Unknown"


@dataclass(frozen=True)
class Dictionary:
    """Definitions in order of precedence, the last match wins."""

    definitions: tuple[Definition, ...] = field(default=())

    @staticmethod
    def of(*rows) -> "Dictionary":
        """From ``(name, pattern, motif, language)`` rows, in order."""
        return Dictionary(tuple(Definition(*row) for row in rows))

    @staticmethod
    def from_table(table: DataFrame) -> "Dictionary":
        """A dictionary is written by hand, one file per application, and becomes part of the plan."""
        rows = table.select("ord", "name", "pattern", "motif", "language").orderBy("ord").collect()
        return Dictionary.of(*[
            (r["name"], r["pattern"], r["motif"] or "", r["language"] or "") for r in rows])

    @property
    def names(self) -> list[str]:
        return [d.name for d in self.definitions]
