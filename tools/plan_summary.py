"""A table of what each query's final plan holds: plan_summary.py [sf dir] [name ...]."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airtally.reports.queries import QUERIES  # noqa: E402
from airtally.session import local_session  # noqa: E402

# Queries that write and read files plan their work while they run.
WRITES = ("sc", "sk", "st")


def final_part(plan: str) -> str:
    """The plan without the initial plans in it; subqueries have one of their own."""
    kept, skipped = [], None
    for line in plan.split("\n"):
        place = len(line) - len(line.lstrip(" :"))
        if skipped is not None and place > skipped:
            continue
        skipped = place if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("| Query | Scans | Row shuffles | Reused | Broadcast joins | Sort-merge joins | Windows | Columns read |")
    print("|---|---|---|---|---|---|---|---|")
    for name, run in QUERIES.items():
        if name.startswith(WRITES) or (sys.argv[2:] and name not in sys.argv[2:]):
            continue
        df = run(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = final_part(plan)
        scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
        columns = [str(len(s.split(","))) if s else "0" for s in scans]
        counts = [
            len(scans),
            len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (hash|range|Single)", plan)),
            plan.count("ReusedExchange"),
            plan.count("BroadcastHashJoin"),
            plan.count("SortMergeJoin"),
            len(re.findall(r"- (?:\*\(\d+\) )?Window \[", plan)),
        ]
        print(f"| `{name}` | " + " | ".join(map(str, counts)) + f" | {', '.join(columns)} |", flush=True)


if __name__ == "__main__":
    main()
