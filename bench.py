"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.session import local_session  # noqa: E402
from roadpulse.suite import registry  # noqa: E402

HEADLINE = (
    "wn01_dedup_slot_5", "wn01_dedup_lineitem", "ag01_segment_hour", "ag13_line_counts",
    "idx01_daily_index", "idx02_weekly_index", "idx03_hourly_index", "idx04_hour_group_index",
    "jn06_join_regions", "jn06_assign_by_line", "inc04_full", "jn07_assign_coarse", "grd06_grid_tci",
    "den02_line_to_cell", "den05_katana", "den07_assign", "wn09_pack",
    "reg03_variation", "cln09_vote", "cln11_impute_lowess", "cln18_run", "str01_segment_hour",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    queries = registry.queries()

    def run(name: str) -> float:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    run("ag01_segment_hour")  # starts the engine
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
