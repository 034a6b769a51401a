"""Write PLANS.md: the executed physical plan shape of every registered query.

    python tools/plans.py [sf_dir]

For each query: exchanges (shuffles), joins and their strategy, aggregates,
windows, subqueries, and each scan's read schema and pushed filters, read
from the final adaptive plan after one execution.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from formweave.plans.registry import QUERIES  # noqa: E402
from formweave.session import get_spark  # noqa: E402

OPS = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
       "Window", "Expand", "Generate", "Subquery", "MapInPandas", "Sort", "ReusedExchange")


def summarize(plan: str) -> tuple[str, list[str]]:
    """Operators and scans of one executed plan (formatted description)."""
    tree, _, details = plan.partition("\n\n")
    tree = tree.split("== Initial Plan ==")[0]
    counts = {op: len(re.findall(rf"(?<![A-Za-z]){op}\b", tree)) for op in OPS}
    scans = []
    for block in details.split("\n\n"):
        schema = re.search(r"ReadSchema: (.*)", block)
        if schema:
            kind = re.search(r"\) Scan (\w+)", block)
            pushed = re.search(r"PushedFilters: (\[.*\])", block)
            scans.append(f"scan `{kind[1] if kind else 'files'}` ReadSchema `{schema[1][:400]}`"
                         + (f" PushedFilters `{pushed[1]}`" if pushed else ""))
    return ", ".join(f"{k} {v}" for k, v in counts.items() if v) or "(scan and project only)", scans


def executions(folder: str) -> list[tuple[float, str]]:
    """Start time and final plan of every SQL execution in the event log."""
    found: dict[int, list] = {}
    for name in os.listdir(folder):
        with open(f"{folder}/{name}") as f:
            for line in f:
                if "sparkPlanInfo" in line:
                    e = json.loads(line)
                    if "time" in e:
                        found[e["executionId"]] = [e["time"] / 1000, e["physicalPlanDescription"]]
                    elif e["executionId"] in found:
                        found[e["executionId"]][1] = e["physicalPlanDescription"]
    return sorted(tuple(x) for x in found.values())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log = tempfile.mkdtemp(prefix="run-")
    spark = get_spark("local[8]", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false", "spark.sql.debug.maxToStringFields": "2000",
        "spark.sql.maxMetadataStringLength": "2000"})
    began: list[tuple[str, float]] = []
    for name, q in QUERIES.items():
        began.append((name, time.time()))
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    began.append(("", time.time() + 1e9))
    spark.stop()
    runs = executions(log)
    out = ["# PLANS", "",
           f"Executed physical plans of the registered queries at `{sf_dir}` (final adaptive plans), one line per",
           "execution: writes and small jobs that a query makes while it is built come first, its own plan last.",
           "Generated by `python tools/plans.py`. Exchange counts exclude broadcast exchanges.", ""]
    for (name, start), (_, end) in zip(began, began[1:]):
        own = [summarize(plan) for at, plan in runs if start <= at < end]
        out += [f"## {name}", ""]
        for i, (ops, scans) in enumerate(own):
            out.append(f"{i + 1}. {ops}")
            out += [f"   * {s}" for s in dict.fromkeys(scans[:4])]
            if len(scans) > 4:
                out.append(f"   * and {len(scans) - 4} more scans")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote {path}")


if __name__ == "__main__":
    main()
