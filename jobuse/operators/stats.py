"""Per-category distribution statistics.

Facts are read once and reduced to *cells*: rows, use and energy by (category
source, value), plus the distinct members (user, project) of each source. All
statistics come from the cells, so no task ever sees the rows of a category, not
even those of ``Overall``:

* a ``Cube`` is one ``GROUPING SETS`` pass with map-side combining, for one report
  or for all reports of a run: a set for the value histogram of each source and
  measure, and one for the members of each source;
* labels are attached to the grouped rows of a report - a row may have several
  labels, and ``Overall`` is one of them - and the grouped rows are combined again;
* quartiles are read off running sums over the cells of a label.

Sizes have few distinct values: a cell is one value, and running sums are taken
part by part, however many there are. Node power is continuous: a cell is one of
``GRID`` equal slices of the plausible range, and a second pass, again one for all
reports, looks only at the slices in which a quartile falls.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from jobuse.functions.scalars import EXACT_SUM, from_limbs, limbs
from jobuse.session import cut, removed, stored, written

CATEGORY, UNIDENTIFIED, OVERALL = 0, 1, 2
OVERALL_LABEL, UNIDENTIFIED_LABEL = "Overall", "Unidentified"

GRID = 65_536
SUB_SLICES = 64
QUARTERS = (1, 2, 3)

# Kinds of grouped rows.
BY_CELL, BY_MEMBER = 0, 1

LABELS = T.ArrayType(T.StructType([
    T.StructField("grp", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("own", T.BooleanType()),
]))


@dataclass(frozen=True)
class Measure:
    """What is distributed: a column, and an upper bound when it is continuous."""

    column: str
    upper: float | None = None
    approx: bool = False        # quartiles from the cells alone

    @property
    def second_pass(self) -> bool:
        return self.upper is not None and not self.approx

    @property
    def error(self) -> float:
        """How far a quartile within the range can be off: nothing, or one slice."""
        return self.upper / GRID if self.upper is not None and self.approx else 0.0

    def cell(self, value: Column) -> Column:
        if self.upper is None:
            return value
        slot = F.floor(value * (GRID / self.upper)).cast("double")
        return F.when(value.isNotNull(), F.least(F.greatest(slot, F.lit(0.0)), F.lit(GRID - 1.0)))


def label(grp: int, text: Column, own: Column | bool = True) -> Column:
    own = own if isinstance(own, Column) else F.lit(own)
    return F.struct(F.lit(grp).alias("grp"), text.alias("label"), own.alias("own"))


def no_labels() -> Column:
    return F.array().cast(LABELS)


def only_label(text: Column) -> Column:
    """The text as the single label of a row; none where it is NULL."""
    return F.when(text.isNotNull(), F.array(label(CATEGORY, text))).otherwise(no_labels())


def parts_of(measure: str, name: str) -> list[Column]:
    """A measure of a fact row, ready to be added up exactly."""
    return [part.alias(f"_{name}{k}") for k, part in enumerate(limbs(F.col(measure)))]


def sum_of_parts(name: str) -> Column:
    return from_limbs(*(F.sum(f"_{name}{k}") for k in range(3)))


def _added(value: Column | str) -> Column:
    """A sum of exact decimals, NULL of nothing."""
    return F.sum(value).cast(EXACT_SUM)


def _zero() -> Column:
    return F.lit(0).cast(EXACT_SUM)


def _exploded(labelled: DataFrame) -> DataFrame:
    every = F.array(label(OVERALL, F.lit(OVERALL_LABEL)))
    return labelled.withColumn("_l", F.explode(F.concat(F.col("labels"), every))).select(
        "*", "_l.grp", "_l.label", "_l.own").drop("_l", "labels")


@dataclass(frozen=True)
class Report:
    """A distribution to be made.

    ``source`` are the columns that a label depends on; ``labeller`` adds a
    ``labels`` array to rows that carry them. ``keep`` restricts the statistics
    but not the totals that shares refer to; it goes with the measure.
    """

    source: dict[str, Column]
    measure: Measure
    labeller: Callable[[DataFrame], DataFrame]
    keep: Column | None = None


def base_rows(facts: DataFrame, reports: list[Report]) -> DataFrame:
    """What reports need of each fact row: sources, members, parts of the sums, and each measure.

    Of measure k there are the value ``_v{k}``, its ``cell{k}`` and whether the row is
    ``_in{k}``; rows outside have no value, and count only towards grand totals. Facts that were
    grouped before (``pregrouped``) bring their own count and parts.
    """
    sources = {name: c for r in reports for name, c in r.source.items()}
    given = "_n" in facts.columns
    sums = [F.col(c) for c in SUMS] if given else [F.lit(1).cast("bigint").alias("_n"), *parts_of("use_s", "w"), *parts_of("energy_j", "e")]
    values = []
    for k, r in enumerate(_measures(reports)):
        inside = F.lit(True) if r.keep is None else F.coalesce(r.keep, F.lit(False))
        value = F.col(r.measure.column).cast("double")
        values += [inside.alias(f"_in{k}"), (value if r.keep is None else F.when(inside, value)).alias(f"_v{k}")]
    rows = facts.select(*[c.alias(name) for name, c in sources.items()], F.col("user_name").alias("_user"),
                        F.col("project_id").alias("_project"), *sums, *values)
    return rows.withColumns({f"cell{k}": r.measure.cell(F.col(f"_v{k}")) for k, r in enumerate(_measures(reports))})


SUMS = ["_n", *(f"_{m}{k}" for m in "we" for k in range(3))]


def pregrouped(facts: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Facts with one row for each combination of ``keys``: for reports that read them several times.

    Grouped facts can be grouped again, or put together with those of other
    periods: sums of parts add up, and nothing else is kept.
    """
    if "_n" in facts.columns:
        return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *extra)
    sums = [F.lit(1).cast("bigint").alias("_n"), *parts_of("use_s", "w"), *parts_of("energy_j", "e")]
    return facts.select("*", *sums).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *extra)


def _measures(reports: list[Report]) -> list[Report]:
    """One report for each measure."""
    return list({r.measure: r for r in reports}.values())


class Cube:
    """The pass over all rows for a set of reports, by category source instead of label.

    ``base`` (see ``base_rows``) is read once for the cells and members, and once
    more where a measure is continuous. With several reports the grouped rows are
    a table in the shared folder; ``close`` removes it.
    """

    def __init__(self, base: DataFrame, reports: list[Report]):
        self.base, self.reports, self.tables = base, reports, []
        self.place = {r.measure: k for k, r in enumerate(_measures(reports))}
        continuous = [k for m, k in self.place.items() if m.upper is not None]
        self.sets = {}
        for r in reports:
            k, names = self.place[r.measure], tuple(r.source)
            self.sets[names, k] = [*names, f"_in{k}", f"cell{k}"]
            flags = {f"_in{self.place[x.measure]}" for x in reports if tuple(x.source) == names}
            self.sets[names, "members"] = [*names, *sorted(flags), "_user", "_project"]
        extremes = [f(f"_v{k}").alias(f"{n}{k}") for k in continuous for n, f in (("lo", F.min), ("hi", F.max))]
        self.rows = self._grouped(base, self.sets, F.sum("_n").alias("n"), sum_of_parts("w").alias("w"),
                                  sum_of_parts("e").alias("e"), *extremes)

    def _grouped(self, rows: DataFrame, sets: dict, *sums: Column) -> DataFrame:
        names = list(dict.fromkeys(c for s in sets.values() for c in s))
        grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in names]).agg(
            F.grouping_id().cast("bigint").alias("gid"), *sums)
        # Spark's id has a bit for each column that a set leaves out, the first column highest.
        self.ids = {**getattr(self, "ids", {}), **{
            key: sum(1 << (len(names) - 1 - k) for k, c in enumerate(names) if c not in s) for key, s in sets.items()}}
        if len(self.reports) == 1:
            return grouped
        self.tables.append(written(grouped, "gid"))
        return self.tables[-1]

    def cells(self, report: Report) -> DataFrame:
        """The cells of a report, by label."""
        k, names = self.place[report.measure], tuple(report.source)
        nobody, gid = F.lit(None).cast("string"), F.col("gid")
        own = gid == F.lit(self.ids[names, k])
        member = gid == F.lit(self.ids[names, "members"])
        low, high = (f"cell{k}",) * 2 if report.measure.upper is None else (f"lo{k}", f"hi{k}")
        inside = F.col(f"_in{k}")
        rows = self.rows.filter(own | member).select(
            *names, inside.alias("_in"), F.when(own, F.lit(BY_CELL)).otherwise(F.lit(BY_MEMBER)).alias("gid"),
            F.when(own, F.col(f"cell{k}")).alias("cell"),
            F.when(member & inside, F.col("_user")).otherwise(nobody).alias("_user"),
            F.when(member & inside, F.col("_project")).otherwise(nobody).alias("_project"),
            "n", "w", "e", F.when(own, F.col(low)).alias("lo"), F.when(own, F.col(high)).alias("hi"))
        return cells_of(rows, report.labeller)

    def values(self, measure: Measure, crossed: list[DataFrame]) -> dict[tuple, DataFrame]:
        """By source: the values of a continuous measure in slices that some report crosses, with counts and use."""
        k = self.place[measure]
        slices = reduce(DataFrame.unionByName, [c.select("cell") for c in crossed])
        # At most GRID distinct slices exist, whatever the data: safe to broadcast.
        slices = F.broadcast(slices.distinct().withColumnRenamed("cell", f"cell{k}"))
        sources = {tuple(r.source) for r in self.reports if r.measure == measure}
        sets = {(names, "values", k): [*names, f"cell{k}", f"_v{k}"] for names in sorted(sources)}
        rows = self._grouped(self.base.join(slices, f"cell{k}"), sets, F.sum("_n").alias("n"), sum_of_parts("w").alias("w"))
        return {names: rows.filter(F.col("gid") == F.lit(self.ids[names, "values", k])).select(
            *names, F.col(f"cell{k}").alias("cell"), F.col(f"_v{k}").alias("_v"), "n", "w") for names in sources}

    def close(self) -> None:
        for table in self.tables:
            removed(table)


def cells_of(grouped: DataFrame, labeller: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Label the grouped rows and combine them into cells.

    A member row stands for a user and for a project; each is made distinct
    within its label before it is counted.
    """
    by_cell = F.col("gid") == BY_CELL
    nobody = F.lit(None).cast("string")
    entries = F.when(by_cell, F.array(F.struct(nobody.alias("user"), nobody.alias("project")))).otherwise(
        F.array(F.struct(F.col("_user").alias("user"), nobody.alias("project")),
                F.struct(nobody.alias("user"), F.col("_project").alias("project"))))
    exploded = _exploded(labeller(grouped)).withColumn("m", F.explode(entries))
    pairs = exploded.groupBy(
        "grp", "label", "_in", "gid", "cell", F.col("m.user").alias("user"),
        F.col("m.project").alias("project"),
    ).agg(F.sum("n").alias("n"), _added("w").alias("w"), _added("e").alias("e"),
          F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("own").alias("own"))
    counted = by_cell & F.col("_in")
    return pairs.groupBy("grp", "label", "cell").agg(
        F.coalesce(F.sum(F.when(counted, F.col("n"))), F.lit(0)).alias("n"),
        _added(F.when(counted, F.col("w"))).alias("w"),
        _added(F.when(counted, F.col("e"))).alias("e"),
        _added(F.when(by_cell, F.col("w"))).alias("all_w"),
        _added(F.when(by_cell, F.col("e"))).alias("all_e"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.count("user").alias("users"), F.count("project").alias("projects"),
        F.max("own").alias("own"))


# ---- quartiles ----------------------------------------------------------------

_LABEL = ["grp", "label"]


def _rank(k: int, up: bool) -> str:
    """0-based rank below or above quartile k of ``tn`` ordered values."""
    return f"{'ceil' if up else 'floor'}((tn - 1) * {k / 4}D)"


def sized_part(value: str) -> Column:
    """Parts of sizes, sixteen to an octave: never falls as the value grows."""
    v = F.col(value)
    return F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * 16)


def running(cells: DataFrame, value: str, keys: list[str], n: str = "n", w: str = "w",
            bounded: bool = False, part: Column | None = None) -> DataFrame:
    """Running counts and weights in value order; missing values come last.

    ``cn``/``cw`` run up to and including the row, ``tn``/``tw`` are the totals.
    Rows with a missing value keep their weight (an exact decimal) but have no
    rank. ``cells`` is read twice, so it should be a written table. Each key is
    added up in parts, in the order of ``part`` (which never falls as the value
    grows), and the sums of the parts before are added. Only where the cells of a
    key are ``bounded`` by construction does one task see them all.
    """
    ranked = F.expr(f"if({value} IS NOT NULL, {n}, 0)")
    weight = F.coalesce(F.col(w), _zero())
    ordered = F.col(value).asc_nulls_last()
    if bounded:
        so_far, whole = _up_to_row(keys, ordered), Window.partitionBy(*keys)
        return cells.select(
            "*", F.sum(ranked).over(so_far).alias("cn"), F.sum(weight).over(so_far).cast(EXACT_SUM).alias("cw"),
            F.sum(ranked).over(whole).alias("tn"), F.sum(weight).over(whole).cast(EXACT_SUM).alias("tw"))
    last = F.lit(float("inf"))
    parts = cells.withColumn("_part", F.coalesce((sized_part(value) if part is None else part).cast("double"), last))
    sums = parts.groupBy(*keys, "_part").agg(F.sum(ranked).alias("_n"), _added(weight).alias("_w"))
    earlier = (Window.partitionBy(*keys).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*keys)
    before = sums.select(
        *keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(earlier).cast(EXACT_SUM), _zero()).alias("_w0"),
        F.sum("_n").over(whole).alias("tn"), F.sum("_w").over(whole).cast(EXACT_SUM).alias("tw"))
    so_far = _up_to_row([*keys, "_part"], ordered)
    inside = parts.select("*", F.sum(ranked).over(so_far).alias("_cn"),
                          F.sum(weight).over(so_far).cast(EXACT_SUM).alias("_cw"))
    return inside.join(before, [*keys, "_part"]).select(
        *cells.columns, (F.col("_n0") + F.col("_cn")).alias("cn"),
        (F.col("_w0") + F.col("_cw")).cast(EXACT_SUM).alias("cw"), "tn", "tw")


def _up_to_row(keys: list[str], order: Column):
    return (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def rank_picks(value: str) -> list[Column]:
    """Order statistics around each quartile (linear interpolation)."""
    return [F.expr("max(tn) AS tn")] + [
        F.expr(f"min(CASE WHEN {value} IS NOT NULL AND cn > {_rank(k, up)} THEN {value} END) "
               f"AS {'hi' if up else 'lo'}{k}")
        for k in QUARTERS for up in (False, True)]


def weight_picks(value: str, w: str = "w") -> list[Column]:
    """Weighted quartiles: the first value whose running weight reaches k/4 of all."""
    return [F.expr(f"min(CASE WHEN {value} IS NOT NULL AND {w} IS NOT NULL AND cw * 4 >= tw * {k} "
                   f"THEN {value} END) AS wq{k}") for k in QUARTERS]


def interpolated(k: int) -> Column:
    position = f"((tn - 1) * {k / 4}D)"
    part = f"({position} - floor({position}))"
    return F.expr(f"lo{k} * (1 - {part}) + hi{k} * {part}")


def _quartile_columns() -> list[Column]:
    return ([interpolated(k).alias(f"q{k}") for k in QUARTERS]
            + [F.col(f"wq{k}") for k in QUARTERS])


def _sums(low: str = "lo", high: str = "hi") -> list[Column]:
    """What is added up over the cells of a label, besides its members."""
    return [
        F.min(low).alias("min"), F.max(high).alias("max"), F.sum("n").alias("jobs"),
        F.coalesce(_added("w"), _zero()).alias("w"), F.coalesce(_added("e"), _zero()).alias("e")]


def _counted() -> list[Column]:
    """The members of a label, which its cells have counted, and whether it is some row's own."""
    return [F.sum("users").alias("users"), F.sum("projects").alias("projects"), F.max("own").alias("own")]


def _exact_quartiles(cells: DataFrame) -> DataFrame:
    """Sums and quartiles when a cell is a single value."""
    picked = running(cells, "cell", _LABEL).groupBy(*_LABEL).agg(
        *_sums(), *_counted(), *rank_picks("cell"), *weight_picks("cell"))
    return picked.select("*", *[interpolated(k).alias(f"q{k}") for k in QUARTERS])


def short_labels(facts: DataFrame, report: Report, key: str) -> DataFrame:
    """Sums and quartiles of labels that have few rows each, from one shuffle of the rows.

    Equal ``key`` means one task, and a label must not have two keys; rows without one take no
    part. A key's rows, and so a label's, must be few: those of a hot key or label belong into a
    ``Cube``. Rows have at most one label each. Values are not cut into cells first, as
    nearly every row of a short label is a cell of its own; rows of one value in any order give
    the same order statistics. The members of a label that carries its user are those of ``user``.
    """
    given = "_n" in facts.columns
    sums = SUMS if given else ["use_s", "energy_j"]
    rows = facts.select(key, *[c.alias(name) for name, c in report.source.items()], F.col("project_id").alias("_project"),
                        F.col(report.measure.column).cast("double").alias("cell"), *sums).filter(F.col(key).isNotNull()).repartition(key)
    if not given:
        rows = rows.withColumns({"_n": F.lit(1).cast("bigint")}).select("*", *parts_of("use_s", "w"), *parts_of("energy_j", "e"))
    labelled = report.labeller(rows).withColumn("label", F.get("labels", F.lit(0))["label"]).filter(F.col("label").isNotNull())
    keys = [key, "label"]
    grouped = labelled.groupBy(*keys, "cell", F.col("user").alias("_user"), "_project").agg(
        F.sum("_n").alias("n"), sum_of_parts("w").alias("w"), sum_of_parts("e").alias("e"))
    members = [F.size(F.collect_set(f"_{m}")).cast("bigint").alias(f"{m}s") for m in ("user", "project")]
    picked = running(grouped, "cell", keys, bounded=True).groupBy(*keys).agg(
        *_sums("cell", "cell"), *members, F.lit(True).alias("own"), *rank_picks("cell"), *weight_picks("cell"))
    return picked.select(F.lit(CATEGORY).alias("grp"), *[c for c in picked.columns if c != key],
                         *[interpolated(k).alias(f"q{k}") for k in QUARTERS])


def _sliced_quartiles(cells: DataFrame) -> DataFrame:
    """Quartiles when a cell is a slice of the range: the middle of the values that the crossed slices hold.

    The cells are a histogram sketch that adds up like sums do. Each quartile is
    within a slice's width of the exact one (rows outside the range share its end
    slices), and needs no second pass.
    """
    run = running(cells, "cell", _LABEL, bounded=True).withColumn("_mid", (F.col("lo") + F.col("hi")) / 2)
    picked = run.groupBy(*_LABEL).agg(*rank_picks("_mid"), *weight_picks("_mid"))
    return picked.select(*_LABEL, *_quartile_columns())


def _crossed_cells(cells: DataFrame) -> DataFrame:
    """Cells in which some quartile falls, with the counts and weights before them.

    At most nine cells per label: two ranks and one weight for each quartile.
    """
    run = running(cells, "cell", _LABEL, bounded=True)      # GRID cells per label
    weight = F.coalesce(F.col("w"), _zero())
    earlier = (Window.partitionBy(*_LABEL).orderBy(F.col("cell").asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    # -1 where no weighted row comes first, so that a zero total is crossed at once.
    before = F.coalesce(F.max(F.when(F.col("w").isNotNull(), F.col("cw"))).over(earlier), F.lit(-1).cast(EXACT_SUM))
    ranks = [f"(cn > {_rank(k, up)} AND cn - n <= {_rank(k, up)})" for k in QUARTERS for up in (False, True)]
    weights = [f"(w IS NOT NULL AND cw * 4 >= tw * {k} AND _before * 4 < tw * {k})" for k in QUARTERS]
    crossed = F.expr(" OR ".join(ranks + weights))
    return run.withColumn("_before", before).filter(F.col("cell").isNotNull() & crossed).select(
        *_LABEL, "cell", (F.col("cn") - F.col("n")).alias("n0"),
        (F.col("cw") - weight).cast(EXACT_SUM).alias("w0"), F.col("tn").alias("all_n"), F.col("tw").alias("all_w"))


def _refined_quartiles(crossed: DataFrame, rows: DataFrame, labeller: Callable[[DataFrame], DataFrame], upper: float) -> DataFrame:
    """Quartiles of a continuous measure from the values (``rows``) in the crossed slices.

    The result no longer reads ``rows``.
    """
    values = cut(_exploded(labeller(rows)).groupBy(*_LABEL, "cell", "_v")
                 .agg(F.sum("n").alias("n"), _added("w").alias("w"))
                 .join(crossed, [*_LABEL, "cell"], "inner"))
    # A slice may be crowded, so it is cut again.
    finer = F.floor(F.col("_v") * (SUB_SLICES * GRID / upper))
    run = running(values, "_v", [*_LABEL, "cell"], part=finer).select(
        *_LABEL, "_v", "w", F.col("all_n").alias("tn"), F.col("all_w").alias("tw"),
        (F.col("n0") + F.col("cn")).alias("cn"), (F.col("w0") + F.col("cw")).cast(EXACT_SUM).alias("cw"))
    picked = run.groupBy(*_LABEL).agg(*rank_picks("_v"), *weight_picks("_v"))
    return picked.select(*_LABEL, *_quartile_columns())


# ---- the distribution table -----------------------------------------------------

def distribution(facts: DataFrame, report: Report, divisor: float) -> DataFrame:
    """One row per label: extremes, both kinds of quartiles, sums, shares, members."""
    return distributions(facts, [report], divisor)[0]


def distributions(facts: DataFrame, reports: list[Report], divisor: float, is_stored: bool = False) -> list[DataFrame]:
    """The distributions of several reports from one pass over the facts (two with a continuous measure).

    Facts that are cheap to read (``is_stored``) are read again for the second
    pass; others are cut down to what is needed and stored in between.
    """
    base = base_rows(facts, reports)
    if is_stored or not any(r.measure.second_pass for r in reports):
        return _from_cube(Cube(base, reports), reports, divisor)
    with stored(base) as table:
        return _from_cube(Cube(table, reports), reports, divisor)


def _from_cube(cube: Cube, reports: list[Report], divisor: float) -> list[DataFrame]:
    cells = [cut(cube.cells(r)) for r in reports]
    quartiles: list[DataFrame | None] = [None] * len(reports)
    for k, r in enumerate(reports):
        if r.measure.upper is not None and r.measure.approx:
            quartiles[k] = _sliced_quartiles(cells[k])
    for measure in {r.measure for r in reports if r.measure.second_pass}:
        at = [k for k, r in enumerate(reports) if r.measure == measure]
        crossed = {k: cut(_crossed_cells(cells[k])) if len(at) > 1 else _crossed_cells(cells[k]) for k in at}
        values = cube.values(measure, list(crossed.values()))
        for k in at:
            r = reports[k]
            quartiles[k] = _refined_quartiles(crossed[k], values[tuple(r.source)], r.labeller, measure.upper)
    cube.close()
    return [_table(c, q, divisor) for c, q in zip(cells, quartiles)]


def distribution_beside(facts: DataFrame, report: Report, short: DataFrame, divisor: float) -> DataFrame:
    """The distribution of a report on sizes, with labels added that ``short_labels`` has made (as a written table).

    Rows of those labels are among the facts, where they count for ``Overall`` and have no label.
    """
    return _table(cut(Cube(base_rows(facts, [report]), [report]).cells(report)), None, divisor, short)


def _table(cells: DataFrame, quartiles: DataFrame | None, divisor: float, more: DataFrame | None = None) -> DataFrame:
    """The distribution from the cells, and the quartiles where cells are not single values (``more`` rows have both)."""
    if quartiles is None:
        rows = _exact_quartiles(cells)
        rows = rows if more is None else rows.unionByName(more)
    else:
        rows = cells.groupBy(*_LABEL).agg(*_sums(), *_counted()).join(quartiles, _LABEL, "left")
    overall = cells.filter(F.col("grp") == OVERALL).agg(F.struct(
        F.coalesce(_added("all_w"), _zero()).cast("double").alias("w"),
        F.coalesce(_added("all_e"), _zero()).cast("double").alias("e")).alias("t"))
    # A category is reported when it is some row's own label and has rows.
    shown = (F.col("grp") == OVERALL) | (F.col("own") & (F.col("jobs") > 0))
    return (rows.filter(shown)
            .withColumns({"_t": overall.scalar(), "w": F.col("w").cast("double"), "e": F.col("e").cast("double")})
            .select(*_LABEL, "min", "q1", "q2", "q3", "max", "wq1", "wq2", "wq3", "jobs",
                    (F.col("w") / F.lit(divisor)).alias("use"),
                    F.try_divide(F.col("w") * 100, F.col("_t.w")).alias("percent_use"),
                    (F.col("e") / F.lit(3.6e6)).alias("kwh"),
                    F.try_divide(F.col("e") * 100, F.col("_t.e")).alias("percent_energy"),
                    "users", "projects"))
