"""Wall time of the headline queries: one warm-up, then the median of three runs.

Environment: ``BENCH_SF_DIR`` (input folder), ``BENCH_CPUS`` (local cores).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from faultline.plans.queries import queries
from faultline.session import local_session

HEADLINE = (
    "recurrence_pairs", "recurrence", "quality_checks", "kpis", "top_interfaces", "top_error_families",
    "ci_error_pairs", "monthly_trend", "dow_hour_matrix", "error_family_pareto", "shortdesc_extract",
    "desc_features", "shortdesc_features", "by_error_family", "by_triplet", "partition_summary",
    "scenario_tall", "stuck_paths_stats", "ftp_iface_verb_code", "misc_top_tokens", "top_offenders",
    "run_summary", "unique_paths", "unique_paths_fixed", "filter_text", "drill_through", "drill_through_all",
)
RUNS = 3


def timed(query, spark, sf_dir: str) -> float:
    """Seconds to build and run the query; building counts, as some queries write a table first."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    seconds = {}
    for name in HEADLINE:
        timed(registry[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(registry[name], spark, sf_dir) for _ in range(RUNS)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
