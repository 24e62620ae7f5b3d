"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up
and is then timed; the rows go to Spark's ``noop`` sink, so nothing is left out of the plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowtide.session import local_session  # noqa: E402
from suite import load_all  # noqa: E402

HEADLINE = (
    "apply_changes",
    "latest_change_per_key",
    "snapshot_diff",
    "reconcile_rows",
    "activity_full_coverage",
    "join_three_way_stats",
    "conformance_report",
    "table_fingerprint",
    "schema_diff",
    "schema_checksum",
    "version_history",
    "stale_gap_alert",
    "chunk_groups",
    "group_by_domain",
    "upsert_sink",
    "compact",
    "stream_upsert",
    "stream_multi_table",
    "stream_activity_tiers",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    entries = load_all()
    taken = {}
    for name in chosen:
        seconds(lambda: entries[name].run(spark, sf_dir))
        taken[name] = round(seconds(lambda: entries[name].run(spark, sf_dir)), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
