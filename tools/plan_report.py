"""Summarise the physical plan of every registered query into PLANS.md.

For each query: number of shuffles (Exchange), join strategies, window-group
limits, scans with their pushed filters and read schema.  Streaming and
store-writing queries are skipped (their plan is built while they run).
usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP_PREFIX = ("stream_", "all_metrics")


def summarise(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w[\w ]*?)(?: \[codegen id : \d+\])?$", plan, re.M)
    pushed = sorted(set(re.findall(r"PushedFilters: (\[.*?\])", plan)))
    schema = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)", plan)))
    return {
        "exchanges": sum(1 for n in nodes if n.startswith("Exchange")),
        "broadcast_exchanges": sum(1 for n in nodes if n.startswith("BroadcastExchange")),
        "joins": sorted({n for n in nodes if n.endswith("Join")}),
        "window_group_limit": any(n.startswith("WindowGroupLimit") for n in nodes),
        "pushed": pushed,
        "read_schema": schema,
    }


def main() -> None:
    from pulseboard.queries import QUERIES
    from pulseboard.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `tools/plan_report.py` on `{sf}` (AQE initial plans; AQE may coalesce partitions"
             " or turn a sort-merge join into a broadcast join at run time).", "",
             "| query | shuffles | broadcasts | joins | WindowGroupLimit | pushed filters |",
             "| --- | --- | --- | --- | --- | --- |"]
    detail = []
    for name, fn in QUERIES.items():
        if name.startswith(SKIP_PREFIX):
            continue
        df = fn(spark, sf)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(plan)
        lines.append(f"| {name} | {s['exchanges']} | {s['broadcast_exchanges']} | {', '.join(s['joins']) or '-'} | "
                     f"{'yes' if s['window_group_limit'] else '-'} | {'; '.join(s['pushed']) or '-'} |")
        detail.append(f"- `{name}` reads {'; '.join(s['read_schema'])}")
    lines += ["", "## Columns read per query (ReadSchema)", "", *detail, ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    print("\n".join(lines[:12]))


if __name__ == "__main__":
    main()
