"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from jobuse.session import local_session  # noqa: E402

HEADLINE = [
    "assemble_usage", "classify_exe", "dist_code_size", "dist_code_size_weighted",
    "dist_code_power_weighted", "dist_motif_size", "dist_area_size", "dist_project_size",
    "energy_code_size", "energy_code_power", "user_split_unidentified", "unidentified_exes",
    "quality_node_power", "top_code_boxstats", "combine_summaries",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def yardstick(sf_dir: str, names: list[str], cpus: int, repeats: int) -> dict[str, float]:
    """The same results from plain SQL in another engine, over the same files: what the machine can do."""
    import duckdb

    from catalog.oracles import ORACLES

    con = duckdb.connect(config={"threads": cpus})
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    times = {}
    for name in names:
        took = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            con.execute(ORACLES[name]).fetchall()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    if os.environ.get("BENCH_YARDSTICK"):
        print(json.dumps(yardstick(sf_dir, names, cpus, repeats)))
        return
    spark = local_session(cpus)
    times = {}
    for name in names:
        run(spark, sf_dir, name)        # warm-up: code generation, file listing
        times[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
