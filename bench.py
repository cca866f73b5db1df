"""Warm timings of headline queries: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the tables and the local cores. Every query is run once to warm up; the value is
the median of three further runs, each collected to Arrow.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tabloom.queries import REGISTRY, Tables
from tabloom.session import local_session

HEADLINE = [
    "t3_top_k_filtered", "a14_fixed_cross_count", "a20_word_count", "a22_frequency_index", "a3_group_median",
    "a10_normalized_share", "a12_pivot_mean", "a19_funnel", "m3_fill_group_median", "m5_fill_neighbours",
    "m6_interpolate_linear", "m7_cap_outliers", "q2_duplicate_count", "q4_describe_by_group", "q6_summary_table",
    "q9_histogram", "j1_inner_join", "j3_full_join", "j5_overlap_report", "j7_fuzzy_join", "w2_pareto_report",
    "w6_rating", "u5_transition_edges", "n2_correlation_matrix", "n3_spearman", "n8_ols_fit", "l10_knn_classify",
    "l12_auc", "h1_extract_cards", "h2_extract_links",
]


def run_once(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(Tables(spark, sf_dir)).toArrow()
    return time.perf_counter() - start


def duck_times(sf_dir: str, names: list[str]) -> dict[str, float]:
    """The same queries as SQL in DuckDB on the same files, for comparison."""
    from tabloom.check import duck

    con, out = duck(sf_dir), {}
    for name in names:
        sql = REGISTRY[name].sql
        if sql is None:
            continue
        con.execute(sql).to_arrow_table()
        start = time.perf_counter()
        con.execute(sql).to_arrow_table()
        out[name] = round(time.perf_counter() - start, 4)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "tabloom-bench")
    times = {}
    for name in names:
        run_once(spark, sf_dir, name)
        times[name] = round(statistics.median(run_once(spark, sf_dir, name) for _ in range(3)), 4)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total seconds of headline queries, median of three warm runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    if os.environ.get("BENCH_DUCKDB"):
        line["duckdb"] = duck_times(sf_dir, names)
    print(json.dumps(line))


if __name__ == "__main__":
    main()
