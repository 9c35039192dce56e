"""Summarise the executed (final adaptive) plan of every named plan.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per plan: shuffle exchanges, broadcast exchanges, reused exchanges, window
and sort operators, and whether scans carry pushed filters. Counts come from
the final AQE plan after a noop write.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracklake.plans.suite import QUERIES  # noqa: E402
from tracklake.session import local_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    rows = []
    for name, fn in QUERIES.items():
        plan = final_plan(fn(spark, sf_dir))
        rows.append(
            (
                name,
                plan.count("ShuffleQueryStage"),
                plan.count("BroadcastQueryStage"),
                plan.count("ReusedExchange"),
                plan.count("Window ["),
                plan.count("WindowGroupLimit"),
                plan.count("TakeOrderedAndProject"),
                "yes" if "PushedFilters: [" in plan and "PushedFilters: []" not in plan else "-",
            )
        )
    print("| plan | shuffle stages | broadcast stages | reused | windows | window group limits | top-k | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for r in rows:
        print("| " + " | ".join(str(x) for x in r) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
