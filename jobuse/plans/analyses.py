"""The named reports, as a table of what they group by and what they measure."""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from jobuse.config import UsageConfig
from jobuse.functions.scalars import EXACT_SUM, exact_sum
from jobuse.operators import stats
from jobuse.operators.classify import (
    UNKNOWN, contained_values, definition_index, pick, with_classes)
from jobuse.operators.filters import is_full_node, without_labels
from jobuse.operators.hotkeys import hot_keys
from jobuse.operators.identity import SPLIT_SOFTWARE, anonymous_users, exe_use, significant_exes, split_by_user
from jobuse.operators.joins import lookup
from jobuse.session import cut, stored, written
from jobuse.sources.definitions import Dictionary

Labeller = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Analysis:
    name: str
    category: str              # Software, Area, ProjectID, Motif, Language, CPUFreq
    power: bool = False        # measure node power instead of size
    match: str = "equality"    # or 'substring': a row counts for every label inside its value
    unidentified: bool = False

    def full_node(self, cfg: UsageConfig) -> bool:
        return self.power and cfg.family == "usage"


USAGE_ANALYSES = {a.name: a for a in [
    Analysis("CodeSize", "Software"),
    Analysis("CodePower", "Software", power=True),
    Analysis("AreaSize", "Area"),
    Analysis("ProjSize", "ProjectID"),
    Analysis("AreaPower", "Area", power=True),
    Analysis("MotifSize", "Motif", match="substring"),
    Analysis("MotifPower", "Motif", power=True, match="substring"),
    Analysis("LangSize", "Language"),
    Analysis("LangPower", "Language", power=True),
    Analysis("CPUFreqSize", "CPUFreq"),
    Analysis("CPUFreqPower", "CPUFreq", power=True),
]}

ENERGY_ANALYSES = {a.name: a for a in [
    Analysis("CodeSize", "Software", match="substring", unidentified=True),
    Analysis("CodePower", "Software", power=True, match="substring", unidentified=True),
    Analysis("AreaSize", "Area", match="substring"),
    Analysis("AreaPower", "Area", power=True, match="substring"),
    Analysis("MotifSize", "Motif", match="substring"),
    Analysis("MotifPower", "Motif", power=True, match="substring"),
]}


def analyses_of(cfg: UsageConfig) -> dict[str, Analysis]:
    return ENERGY_ANALYSES if cfg.family == "energy" else USAGE_ANALYSES


# ---- labels -------------------------------------------------------------------

def _label_array(value: str, candidates: list[str], own: list[str]) -> Column:
    """Candidates that occur inside a value, as a literal array."""
    inside = [stats.label(stats.CATEGORY, F.lit(c), c in own)
              for c in dict.fromkeys(candidates) if c and c in value]
    return F.array(*inside).cast(stats.LABELS) if inside else stats.no_labels()


def _unidentified() -> Column:
    return F.array(stats.label(stats.UNIDENTIFIED, F.lit(stats.UNIDENTIFIED_LABEL)))


def _by_definition(arrays: list[Column], default: Column) -> Labeller:
    """Labels that follow from the matched definition (column ``code``) alone."""
    return lambda rows: rows.withColumn("labels", pick(F.col("code"), arrays, default))


def software_labels(dictionary: Dictionary, analysis: Analysis, cfg: UsageConfig) -> Labeller:
    names = dictionary.names
    if analysis.match == "substring":
        arrays = [_label_array(n, names, [n]) for n in names]
    else:
        arrays = [_label_array(n, [n], [n]) for n in names]
    if cfg.family == "energy":
        default = _unidentified() if analysis.unidentified else stats.no_labels()
    else:
        default = _label_array(UNKNOWN, [UNKNOWN], [UNKNOWN])
    return _by_definition(arrays, default)


def motif_labels(dictionary: Dictionary, occurring: set[str] | None = None) -> Labeller:
    """Motif words that occur in the data and lie inside a row's motif.

    Without ``occurring`` a word counts as occurring when the reported rows have it.
    """
    motifs = [d.motif for d in dictionary.definitions]
    words = [t for m in [*motifs, UNKNOWN] for t in m.split()]
    if occurring is not None:
        words = [t for t in words if t in occurring]

    def labels(motif: str) -> Column:
        return _label_array(motif, words, words if occurring is not None else motif.split())

    return _by_definition([labels(m) for m in motifs], labels(UNKNOWN))


def motif_words(facts: DataFrame, dictionary: Dictionary) -> set[str]:
    """Motif words of all rows; at most one row per definition reaches the driver."""
    found = facts.select(definition_index(F.col("exe_name"), dictionary).alias("code")).distinct()
    motifs = [UNKNOWN if r["code"] is None else dictionary.definitions[r["code"]].motif for r in found.collect()]
    return {t for m in motifs for t in m.split()}


def language_labels(dictionary: Dictionary) -> Labeller:
    """Languages are listed word by word but compared as a whole."""
    words = {t for d in dictionary.definitions for t in d.language.split()} | {UNKNOWN}
    arrays = [_label_array(d.language, [d.language] if d.language in words else [], [d.language])
              for d in dictionary.definitions]
    return _by_definition(arrays, _label_array(UNKNOWN, [UNKNOWN], [UNKNOWN]))


def column_labels(column: str) -> Labeller:
    return lambda rows: rows.withColumn("labels", stats.only_label(F.col(column)))


def area_labels(areas: DataFrame, analysis: Analysis) -> Labeller:
    """``areas`` holds (project_id, area) with one row per project."""
    if analysis.match == "substring":
        inside = contained_values(areas, "area")
        table = areas.join(inside, "area").groupBy("project_id").agg(
            F.collect_set(stats.label(stats.CATEGORY, F.col("inner"))).alias("labels"))
    else:
        table = areas.select("project_id", stats.only_label(F.col("area")).alias("labels"))

    def labeller(rows: DataFrame) -> DataFrame:
        joined = lookup(rows, table, "project_id")
        return joined.withColumn("labels", F.coalesce("labels", stats.no_labels()))
    return labeller


SPREAD = 1024       # keys over which rows are dealt that look no user up
KEY = "_key"        # what rows of labels that carry the user lie by: the user, or the label


def carries_user(dictionary: Dictionary) -> Column:
    """Whether the label of a row with ``code`` and ``big`` carries its user."""
    software = pick(F.col("code"), dictionary.names, F.lit(None).cast("string"))
    return F.col("big").isNotNull() | F.coalesce(software.isin(SPLIT_SOFTWARE), F.lit(False))


def _user_key(user: Column) -> Column:
    """A user as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), user), F.lit("null"))


def _who(rows: DataFrame, users: DataFrame | None, cfg: UsageConfig, carries: Column) -> DataFrame:
    """Add the name that the ``user`` of rows whose label carries it is shown under.

    Rows that lie by ``KEY`` are joined where they lie. Among others are rows without a user:
    they are dealt by a hash of their columns, or they would be one key.
    """
    if not cfg.anonymise:
        return rows.withColumn("who", F.col("user"))
    named = users.select(_user_key(F.col("user_name")).alias("_u"), F.col("anon_user").alias("who"))
    if KEY in rows.columns:
        return rows.join(named, F.col(KEY) == F.col("_u"), "left").drop("_u")
    dealt = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)).cast("string")
    looked_up = rows.withColumn("_k", F.when(carries, _user_key(F.col("user"))).otherwise(dealt))
    return looked_up.join(named, F.col("_k") == F.col("_u"), "left").drop("_k", "_u")


def split_label(dictionary: Dictionary, cfg: UsageConfig) -> Column:
    """Application label of rows with ``code``, ``big`` and ``who``: generic and
    significant unidentified executables carry the user."""
    default = F.lit(None).cast("string") if cfg.family == "energy" else F.lit(UNKNOWN)
    software = pick(F.col("code"), dictionary.names, default)
    return F.when(F.col("big").isNotNull(), F.concat(F.col("big"), F.lit("_"), F.col("who"))).otherwise(
        split_by_user(software, F.col("who")))


def split_sources(rows: DataFrame, dictionary: Dictionary, by_exe: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Add what a label that may carry the user depends on: ``code``, ``big`` and ``user``.

    ``by_exe`` is the use of each executable: unidentified ones with significant use are
    labelled by their own name (``big``). Only where the label carries the user is there one,
    so that rows of all users with another label are grouped together.
    """
    big = significant_exes(by_exe, dictionary, cfg).select("exe_name", F.col("exe_name").alias("big"))
    coded = lookup(rows.withColumn("code", definition_index(F.col("exe_name"), dictionary)), big, "exe_name")
    return coded.withColumn("user", F.when(carries_user(dictionary), F.col("user_name")))


def split_labels(dictionary: Dictionary, users: DataFrame | None, analysis: Analysis, cfg: UsageConfig) -> Labeller:
    """Labels that carry the user, for rows grouped by what ``split_sources`` adds.

    Which labels there are is settled by the rows of the first call, which must be
    all; a later call may see some of them only.
    """
    known: list[DataFrame] = []

    def labeller(rows: DataFrame) -> DataFrame:
        named = _who(rows, users, cfg, carries_user(dictionary)).withColumn("split", split_label(dictionary, cfg))
        if analysis.match == "substring":
            if not known:
                named = cut(named)      # read twice
                known.append(written(contained_values(named, "split").groupBy("split").agg(F.collect_set(
                    stats.label(stats.CATEGORY, F.col("inner"), F.col("inner") == F.col("split"))).alias("labels"))))
            named = named.join(known[0], "split", "left").withColumn(
                "labels", F.coalesce("labels", stats.no_labels()))
        else:
            named = named.withColumn("labels", stats.only_label(F.col("split")))
        if analysis.unidentified:
            # A row whose user is missing has no label; it is not unidentified.
            plain = F.col("code").isNull() & F.col("big").isNull()
            named = named.withColumn("labels", F.when(plain, _unidentified()).otherwise(F.col("labels")))
        return named.drop("split", "who")
    return labeller


# ---- reports --------------------------------------------------------------------

def _measure(analysis: Analysis, cfg: UsageConfig) -> stats.Measure:
    if analysis.power:
        return stats.Measure("node_power", cfg.max_power, cfg.approx)
    return stats.Measure(cfg.size_measure)


def _report(facts: DataFrame, analysis: Analysis, cfg: UsageConfig, dictionary: Dictionary | None = None,
            areas: DataFrame | None = None, all_facts: DataFrame | None = None) -> stats.Report:
    """What a report groups by, measures and labels (those whose labels do not carry the user)."""
    source = {}
    if dictionary is not None:
        source = {"code": definition_index(F.col("exe_name"), dictionary)}
    if analysis.category == "Software":
        labeller = software_labels(dictionary, analysis, cfg)
    elif analysis.category == "Motif":
        labeller = motif_labels(dictionary, None if all_facts is None else motif_words(all_facts, dictionary))
    elif analysis.category == "Language":
        labeller = language_labels(dictionary)
    elif analysis.category == "Area":
        source, labeller = {"project_id": F.col("project_id")}, area_labels(areas, analysis)
    elif analysis.category == "ProjectID":
        source, labeller = {"project_id": F.col("project_id")}, column_labels("project_id")
    elif analysis.category == "CPUFreq":
        source, labeller = {"cpu_freq": F.col("cpu_freq")}, column_labels("cpu_freq")
    else:
        raise ValueError(f"unknown category {analysis.category!r}")
    return stats.Report(source, _measure(analysis, cfg), labeller, is_full_node(cfg) if analysis.full_node(cfg) else None)


def distributions_of(facts: DataFrame, analyses: list[Analysis], cfg: UsageConfig, is_stored: bool = False,
                     users: DataFrame | None = None, **inputs) -> list[DataFrame]:
    """The distributions of several analyses, from one cube of the facts (see ``stats.distributions``).

    ``inputs`` are those of ``distribution_of``. Labels that carry the user have a
    cube of their own.
    """
    together = [a for a in analyses if not (a.category == "Software" and cfg.user_split)]
    found = stats.distributions(facts, [_report(facts, a, cfg, **inputs) for a in together], cfg.use_divisor, is_stored) if together else []
    made = dict(zip(together, found))
    return [made[a] if a in made else _split_distribution(facts, a, cfg, inputs["dictionary"], users, inputs.get("all_facts"))
            for a in analyses]


def distribution_of(facts: DataFrame, analysis: Analysis, cfg: UsageConfig,
                    dictionary: Dictionary | None = None, areas: DataFrame | None = None,
                    users: DataFrame | None = None, all_facts: DataFrame | None = None) -> DataFrame:
    """Both distributions of one analysis in one frame (see ``stats.distribution``).

    User labels and motif words are taken before the restriction to a project:
    ``all_facts`` are the facts without it (by default the facts themselves).
    """
    return distributions_of(facts, [analysis], cfg, dictionary=dictionary, areas=areas, users=users, all_facts=all_facts)[0]


def _split_distribution(facts: DataFrame, analysis: Analysis, cfg: UsageConfig, dictionary: Dictionary,
                        users: DataFrame | None, all_facts: DataFrame | None) -> DataFrame:
    """Labels that carry the user.

    Use of executables, users in order of appearance and the cells all come from one
    table: the columns needed of the facts, or the grouped facts of stored periods. It
    is not grouped first: by executable, user, project and value it stays about as long.
    """
    measure = _measure(analysis, cfg)
    keys = ["exe_name", "user_name", "project_id", measure.column]
    keys += ["ngpus" if cfg.gpu else "cores"] if analysis.full_node(cfg) else []
    own_users = users is None and cfg.anonymise and all_facts is None
    grouped = "_n" in facts.columns
    needed = [*keys, "use_s", "energy_j", *(["src", "job_id", "sub_job_id"] if own_users else [])]
    with nullcontext(facts) if grouped else stored(facts.select(*dict.fromkeys(needed))) as rows:
        if users is None and cfg.anonymise:
            users = anonymous_users(rows if own_users else all_facts)
        rows = split_sources(rows, dictionary, cut(exe_use(rows)), cfg)
        if analysis.match == "equality" and measure.upper is None:
            return _split_by_key(rows, measure, users, analysis, cfg, dictionary)
        source = {name: F.col(name) for name in ("code", "big", "user")}
        report = stats.Report(source, measure, split_labels(dictionary, users, analysis, cfg),
                              is_full_node(cfg) if analysis.full_node(cfg) else None)
        return stats.distributions(rows, [report], cfg.use_divisor, is_stored=True)[0]


def _split_by_key(rows: DataFrame, measure: stats.Measure, users: DataFrame | None, analysis: Analysis, cfg: UsageConfig,
                  dictionary: Dictionary) -> DataFrame:
    """Sizes by labels that carry the user, nearly all of which have few rows.

    These are shuffled once, by user where users are anonymous (that settles the label,
    whose end ``_user{i}`` is the user's own) and by label otherwise, and everything else happens
    where they lie. All rows of a cube are those of other labels, and of hot users or labels;
    so are those with the text of a label that carries no user, which are one label.
    """
    names, carries = [*dictionary.names, UNKNOWN], carries_user(dictionary)
    label = split_label(dictionary, cfg)
    key = _user_key(F.col("user")) if cfg.anonymise else label
    if not cfg.anonymise:
        rows = rows.withColumn("who", F.col("user"))
    rows = rows.withColumn(KEY, F.when(carries, key))
    few = [k for k in hot_keys(rows.filter(F.col(KEY).isNotNull()), KEY).parts if k is not None]
    few_users = None
    if cfg.anonymise:
        # At most as many users as names are in the dictionary, and as keys may be hot.
        alike = [end for name in names for end in re.findall(r"_(user\d+)$", name)]
        few_users = users.filter(_user_key(F.col("user_name")).isin(few) | F.col("anon_user").isin(alike))
        few = [r["k"] for r in few_users.select(_user_key(F.col("user_name")).alias("k")).collect()]
        few_users = F.broadcast(few_users)
    else:
        few += names
    apart = F.col(KEY).isNotNull() & ~F.col(KEY).isin(few)
    source = {name: F.col(name) for name in ("code", "big", "user")}
    short = written(stats.short_labels(
        rows.withColumn(KEY, F.when(apart, F.col(KEY))), stats.Report(source, measure, split_labels(dictionary, users, analysis, cfg)), KEY))

    def labeller(grouped: DataFrame) -> DataFrame:
        labelled = split_labels(dictionary, few_users, analysis, cfg)(grouped)
        return labelled.withColumn("labels", F.when(F.col("apart"), stats.no_labels()).otherwise(F.col("labels")))

    masked = {name: F.when(~apart, c) for name, c in source.items()}
    return stats.distribution_beside(rows, stats.Report(masked | {"apart": apart}, measure, labeller), short, cfg.use_divisor)


def report_table(dist: DataFrame, analysis: Analysis, cfg: UsageConfig,
                 weighted: bool = False) -> DataFrame:
    """The report's columns, by use, largest first."""
    q = "wq" if weighted else "q"
    table = dist.select(
        F.col("label").alias(analysis.category), F.col("min").alias("Min"),
        F.col(f"{q}1").alias("Q1"), F.col(f"{q}2").alias("Median"), F.col(f"{q}3").alias("Q3"),
        F.col("max").alias("Max"), F.col("jobs").alias("Jobs"), F.col("use").alias(cfg.unit_name),
        F.col("percent_use").alias("PercentUse"), F.col("kwh").alias("kWh"),
        F.col("percent_energy").alias("PercentEnergy"), F.col("users").alias("Users"),
        F.col("projects").alias("Projects"))
    return report_projection(table, cfg).orderBy(F.desc("PercentUse"), F.asc(analysis.category))


def report_projection(table: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Hide energy (usage family, by default) or absolute values (web energy tables)."""
    if cfg.family == "energy":
        return table.drop("Nodeh", "kWh") if cfg.web else table
    return table if cfg.shows_energy else table.drop("kWh", "PercentEnergy")


def report(facts: DataFrame, name: str, cfg: UsageConfig, weighted: bool = False,
           **inputs) -> DataFrame:
    """One named report from a fact frame."""
    analysis = analyses_of(cfg)[name]
    return report_table(distribution_of(facts, analysis, cfg, **inputs), analysis, cfg, weighted)


def code_use_ranking(facts: DataFrame, cfg: UsageConfig, dictionary: Dictionary) -> DataFrame:
    """Share of use by application, without the summary rows (bar-chart data)."""
    full = replace(cfg, report_energy=True, web=False)
    ranked = without_labels(report(facts, "CodeSize", full, weighted=True, dictionary=dictionary),
                            "Software")
    return ranked.select("Software", cfg.unit_name, "PercentUse").orderBy(
        F.desc("PercentUse"), F.asc("Software"))


# ---- top applications ---------------------------------------------------------------

TOP_CODES = 15      # fixed value: applications in the box statistics


def code_sizes(facts: DataFrame, cfg: UsageConfig, dictionary: Dictionary) -> DataFrame:
    """(software, value) with use and whole hours of use, grouped before tagging."""
    whole = F.floor(F.coalesce(F.col("use_s"), F.lit(0.0)) / cfg.use_divisor)
    by_exe = facts.groupBy("exe_name", F.col(cfg.size_measure).alias("value")).agg(
        exact_sum(F.col("use_s")).alias("use_s"), F.sum(whole).alias("copies"))
    return with_classes(by_exe, dictionary, cfg.family).filter(F.col("software").isNotNull()).groupBy(
        "software", "value").agg(
        F.sum("use_s").cast(EXACT_SUM).alias("use_s"), F.sum("copies").alias("copies"))


def top_codes(sizes: DataFrame, count: int = TOP_CODES) -> DataFrame:
    """The applications with most use; Overall never takes part."""
    return sizes.groupBy("software").agg(
        F.sum("use_s").cast("double").alias("use_s"), F.sum("copies").alias("copies")).orderBy(
        F.desc("use_s"), F.asc("software")).limit(count)


def top_code_boxes(facts: DataFrame, cfg: UsageConfig, dictionary: Dictionary) -> DataFrame:
    """Quartiles, mean and whiskers of job size, each row counted once per whole
    hour of use, for the top applications. Rows are never repeated: the statistics
    are read off the counts of each size."""
    sizes = cut(code_sizes(facts, cfg, dictionary))
    best = top_codes(sizes).select("software", F.col("use_s").alias("_total"))
    rows = sizes.filter("copies > 0").join(F.broadcast(best), "software", "left_semi")
    run = stats.running(rows, "value", ["software"], n="copies", w="use_s")
    ranks = run.groupBy("software").agg(
        *stats.rank_picks("value"),
        F.sum(F.col("value") * F.when(F.col("value").isNotNull(), F.col("copies"))).alias("_sum"))
    box = ranks.select("software", "tn", F.try_divide("_sum", "tn").alias("mean"),
                       *[stats.interpolated(k).alias(f"q{k}") for k in stats.QUARTERS])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low = F.min(F.when(F.col("value") >= F.col("q1") - reach, F.col("value")))
    high = F.max(F.when(F.col("value") <= F.col("q3") + reach, F.col("value")))
    boxes = rows.join(F.broadcast(box), "software").groupBy("software").agg(
        F.max("q1").alias("q1"), F.max("q2").alias("median"), F.max("q3").alias("q3"),
        F.max("mean").alias("mean"), F.max("tn").alias("copies"),
        F.least(low, F.max("q1")).alias("whisker_low"),
        F.greatest(high, F.max("q3")).alias("whisker_high"))
    # An application without a whole hour in any row keeps its place, without a box.
    return best.join(boxes, "software", "left").select(
        *boxes.columns, (F.col("_total") / cfg.use_divisor).alias("use"),
    ).orderBy(F.desc("use"), F.asc("software"))


def repeated_rows(facts: DataFrame, cfg: UsageConfig) -> DataFrame:
    """Each row repeated once per whole hour of use, for export only."""
    copies = F.floor(F.col("use_s") / cfg.use_divisor).cast("bigint")
    return facts.filter(copies >= 1).select(
        "*", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("copy"))
