"""Distribution statistics against a row-by-row restatement, on random and odd frames."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from jobuse.functions import scalars
from jobuse.operators import stats

SCHEMA = T.StructType([
    T.StructField("cat", T.StringType()), T.StructField("v", T.DoubleType()),
    T.StructField("use_s", T.DoubleType()), T.StructField("energy_j", T.DoubleType()),
    T.StructField("user_name", T.StringType()), T.StructField("project_id", T.StringType()),
    T.StructField("big", T.BooleanType()),
])


def linear_quantile(values, p):
    values = sorted(values)
    if not values:
        return None
    at = p * (len(values) - 1)
    lo, part = math.floor(at), at - math.floor(at)
    return values[lo] * (1 - part) + values[math.ceil(at)] * part


def weighted_quantile(rows, p):
    """First value, missing ones last, whose running weight reaches p of the total."""
    rows = sorted(((v, w) for v, w in rows if w is not None), key=lambda r: (r[0] is None, r[0] or 0))
    total, running = sum(w for _, w in rows), 0.0
    for value, weight in rows:
        running += weight
        if running >= p * total:
            return value
    return None


def expected(rows, inside=lambda r: True):
    all_w = sum(r[2] or 0 for r in rows)
    out = {}
    labels = {r[0] for r in rows if r[0] is not None and inside(r)} | {"Overall"}
    for name in labels:
        part = [r for r in rows if inside(r) and (name == "Overall" or r[0] == name)]
        values = [r[1] for r in part if r[1] is not None]
        pairs = [(r[1], r[2]) for r in part]
        use = sum(r[2] or 0 for r in part)
        out[name] = (
            min(values, default=None), max(values, default=None),
            *[linear_quantile(values, p) for p in (.25, .5, .75)],
            *[weighted_quantile(pairs, p) for p in (.25, .5, .75)],
            len(part), use, None if all_w == 0 else use * 100 / all_w,
            len({r[4] for r in part} - {None}), len({r[5] for r in part} - {None}))
    return out


def actual(spark, rows, upper=None, keep=None):
    facts = spark.createDataFrame(rows, SCHEMA)
    report = stats.Report({"cat": F.col("cat")}, stats.Measure("v", upper),
                          lambda df: df.withColumn("labels", stats.only_label(F.col("cat"))), keep)
    table = stats.distribution(facts, report, 1.0)
    return {r["label"]: (r["min"], r["max"], r["q1"], r["q2"], r["q3"], r["wq1"], r["wq2"], r["wq3"],
                         r["jobs"], r["use"], r["percent_use"], r["users"], r["projects"])
            for r in table.collect()}


def check(found, wanted):
    assert set(found) == set(wanted)
    for name, row in wanted.items():
        same = [a == b if a is None or b is None else math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
                for a, b in zip(found[name], row, strict=True)]
        assert all(same), (name, found[name], row)


def random_rows(seed, n, draw):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        cat = rng.choice(["hot", "hot", "hot", "b", "c", None])
        value = None if rng.random() < .08 else float(draw(rng))
        weight = None if rng.random() < .05 else float(rng.integers(0, 50))
        energy = None if rng.random() < .1 else float(rng.integers(0, 1000))
        user = None if rng.random() < .05 else f"u{rng.integers(0, 12)}"
        rows.append((cat if cat is None else str(cat), value, weight, energy, user,
                     f"p{rng.integers(0, 4)}", bool(rng.random() < .6)))
    return rows


DRAWS = {
    "sizes": (None, lambda r: r.integers(1, 9) * 16),
    "power": (850.0, lambda r: r.gamma(4.0, 80.0)),
    "ties": (850.0, lambda r: r.choice([0.0, 100.25, 100.25, 100.26, 849.9, 850.0])),
    "narrow": (850.0, lambda r: 300 + r.random() * 1e-6),     # a single slice of the grid
    "outside": (1.0, lambda r: r.normal(0, 30)),              # beyond both ends of the grid
}


@pytest.mark.parametrize("kind", DRAWS)
@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, kind, seed):
    upper, draw = DRAWS[kind]
    rows = random_rows(seed, 700, draw)
    check(actual(spark, rows, upper), expected(rows))


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_large_sums_are_exact(spark, parts):
    """Totals beyond 2**53 equal whole-number arithmetic, however rows are spread."""
    rng = random.Random(9)
    use = [rng.randrange(1, 1 << 50) * 2 + 1 for _ in range(400)]
    rows = [(rng.choice("ab"), float(rng.randrange(9)), float(u), u / 128.0) for u in use]
    cells = spark.createDataFrame(rows, "label string, value double, use_s double, energy_j double").repartition(parts)
    got = cells.groupBy("label").agg(scalars.exact_sum(F.col("use_s")).alias("w"), scalars.exact_sum(F.col("energy_j")).alias("e")).collect()
    for label, w, e in got:
        assert int(w) == sum(int(r[2]) for r in rows if r[0] == label) and w == int(w)
        assert e == sum(Decimal(r[3]) for r in rows if r[0] == label)
    run = stats.running(cells.groupBy("label", "value").agg(F.count("*").alias("n"), scalars.exact_sum(F.col("use_s")).alias("w")), "value", ["label"])
    for r in run.collect():
        assert r["cw"] == sum(int(x[2]) for x in rows if x[0] == r["label"] and x[1] <= r["value"])
        assert r["tw"] == sum(int(x[2]) for x in rows if x[0] == r["label"])


@pytest.mark.parametrize("upper", [None, 850.0])
def test_restricted_rows_count_for_totals_only(spark, upper):
    rows = random_rows(3, 400, lambda r: r.integers(1, 40))
    check(actual(spark, rows, upper, F.col("big")), expected(rows, lambda r: r[6]))


ODD = {
    "single": [("a", 5.0, 2.0)],
    "null values hold most weight": [("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", None, 9.0)],
    "null weights": [("a", 1.0, None), ("a", 2.0, None)],
    "some null weights": [("a", 1.0, None), ("a", 2.0, 3.0), ("a", 3.0, 3.0)],
    "zero weights": [("a", 3.0, 0.0), ("a", 1.0, None), ("a", 2.0, 0.0)],
    "ties at the cutoff": [("a", 1.0, 1.0), ("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", 2.0, 1.0)],
    "no values": [("a", None, 1.0), ("a", None, 2.0)],
}


@pytest.mark.parametrize("name", ODD)
@pytest.mark.parametrize("upper", [None, 850.0])
def test_odd_frames(spark, name, upper):
    rows = [(c, v, w, 1.0, "u", "p", True) for c, v, w in ODD[name]]
    check(actual(spark, rows, upper), expected(rows))


def test_empty_input_gives_no_rows(spark):
    assert actual(spark, []) == {}


def test_empty_restriction_gives_empty_statistics(spark):
    rows = [("a", 1.0, 4.0, 1.0, "u", "p", False)]
    for upper in (None, 850.0):
        found = actual(spark, rows, upper, F.col("big"))
        assert found == {"Overall": (None,) * 8 + (0, 0.0, 0.0, 0, 0)}


def test_invariants(spark):
    rows = [r for r in random_rows(9, 600, lambda r: r.integers(1, 30))]
    found = actual(spark, rows)
    overall = found.pop("Overall")
    assert sum(r[8] for r in found.values()) == overall[8] - sum(r[0] is None for r in rows)
    assert overall[10] == 100
    for low, high, q1, q2, q3, w1, w2, w3, *_ in [*found.values(), overall]:
        assert low <= q1 <= q2 <= q3 <= high
        assert low <= w1 <= w2 <= w3 <= high
