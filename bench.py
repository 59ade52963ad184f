"""Benchmark the headline plans.

Runs each plan at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each plan is executed in full with the no-op sink (every row computed,
nothing collected to the driver).  Before its timed run, each plan runs once
on the small warm-up data ($BENCH_WARM_DIR, default sf0.001): JVM JIT,
Python workers and Spark's generated-code cache are then warm, so the timed
run measures the plan at $BENCH_SF_DIR rather than one-off compilation (a
long-running cluster job amortizes that cost).  The JSON records the warm-up
directory.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleaner.plans import registry  # noqa: E402
from gleaner.session import build_session  # noqa: E402

HEADLINE = [
    "html_strip_text",
    "relevance_filter",
    "record_widen",
    "xml_metadata",
    "match_candidates",
    "resolve_projects",
    "crawl_frontier",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus, app_name="gleaner-bench")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    plans = registry.plans()
    times = {}
    failed = []
    for name in names:
        try:
            plans[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            t0 = time.perf_counter()
            plans[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
            print(f"{name}: {times[name]}s", file=sys.stderr)
        except Exception as e:  # noqa: BLE001 -- report, keep measuring the rest
            failed.append(name)
            print(f"{name}: FAILED {str(e)[:300]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "warmup": warm_dir, "failed": failed}))
    spark.stop()


if __name__ == "__main__":
    main()
