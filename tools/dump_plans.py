"""Write PLANS.md: the condensed physical plan of every registered query.

Only the nodes that matter at scale are kept (scans with their pruned schema and
pushed filters, exchanges, joins, windows, aggregates, Python stages).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "FileScan", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "ArrowEvalPython",
        "MapInArrow", "MapInPandas", "Window", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
        "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "TakeOrderedAndProject",
        "GlobalLimit", "CollectLimit", "InMemoryTableScan", "Generate")


def condensed(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            if "FileScan" in line:
                indent = line[:line.index("+-") + 3] if "+-" in line else ""
                table = re.search(r"/([a-z_]+)\.parquet", line)
                pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
                schema = re.search(r"ReadSchema: (struct<.*>)", line)
                line = (f"{indent}FileScan {table.group(1) if table else ''} "
                        f"PushedFilters: {pushed.group(1) if pushed else '[]'} "
                        f"ReadSchema: {schema.group(1) if schema else '?'}")
                out.append(line.rstrip())
            else:
                out.append(line.rstrip()[:200])
    return out


def main(sf_dir: str = "/root/testdata/sf0.01", path: str = "PLANS.md") -> None:
    from parlance.plans.catalog import QUERIES
    from parlance.session import get_session
    spark = get_session(app="parlance-plans", cpus=8)
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `tools/dump_plans.py` at {sf_dir} (local[8], 8 shuffle partitions, AQE on; "
             "initial plans, before AQE re-planning). Only scans, exchanges, joins, windows, aggregates "
             "and Python stages are listed.", ""]
    for name, fn in QUERIES.items():
        lines += [f"## {name}", "", "```"] + condensed(fn(spark, sf_dir)) + ["```", ""]
    with open(path, "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
