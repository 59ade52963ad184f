"""Print the formatted physical plan of named plans (default: the bench set).

usage: python scripts/explain_plans.py [sf_dir] [name ...]
Look for: ReadSchema / PushedFilters on each scan, WholeStageCodegen spans,
BroadcastHashJoin only on bounded sides, WindowGroupLimit before top-k
shuffles, ArrowEvalPython only where a Python helper is intended.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from gleaner.plans import registry  # noqa: E402
from gleaner.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = build_session("local[8]", 8)
    plans = registry.plans()
    for name in names:
        df = plans[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"==== {name}: scans={plan.count('FileScan')} "
              f"exchanges={plan.count('Exchange')} python={plan.count('ArrowEvalPython')}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
