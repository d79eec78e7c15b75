"""Summarise the final (adaptive) physical plans of every registered library query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query is built and collected (small tables). What counts is every plan that ran: the query's own, whole, and those
of the jobs that run while it is built (small tables of bins, the dictionary). Initial plans, which adaptive execution
replaces, are left out wherever they are nested. Scans are counted one by one; a scan behind a reused exchange is not run again and
not counted.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
         "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
         "WindowGroupLimit", "Generate", "TakeOrderedAndProject", "InMemoryTableScan", "ReusedExchange", "MapInArrow", "MapInPandas")
TREE = re.compile(r"^[\s:+]")
NODE = re.compile(r"^[\s:+\-*()\d]*(?=[A-Z])")


def final_lines(plan: str) -> list[str]:
    """The plan's lines without any initial plan, at whatever depth one stands."""
    out, skip = [], None
    for i, line in enumerate(plan.splitlines()):
        if i and not TREE.match(line):
            continue  # the rest of a literal with a line break
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip and "== Final Plan ==" not in line:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return out


def _text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plans_run(build) -> list[str]:
    """The final plans of all jobs of a query: those that run while ``build()`` makes it, then its own."""
    from pyspark.sql import SparkSession

    from kinfold.operators import joins, scoring, stats
    SparkSession.active().conf.set("spark.sql.maxMetadataStringLength", "4000")  # else scans lose their table's name
    ran: list[str] = []
    original = joins.local_copy

    def recorded(df, max_rows):
        limited = df.limit(max_rows + 1)
        rows = limited.collect()
        ran.append(_text(limited))
        from pyspark.sql import functions as F
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= max_rows else df

    for module in (joins, scoring, stats):
        module.local_copy = recorded
    try:
        df = build()
        df.collect()  # this DataFrame's own execution: its adaptive plan becomes final
    finally:
        for module in (joins, scoring, stats):
            module.local_copy = original
    return [*ran, _text(df)]


def summarise(plans: list[str]) -> dict:
    lines = [line for p in plans for line in final_lines(p)]
    counts: dict[str, int] = {}
    scans = []
    for line in lines:
        node = NODE.sub("", line)
        for n in NODES:
            if node.startswith(n) and not node[len(n):len(n) + 1].isalpha():
                counts[n] = counts.get(n, 0) + 1
        if m := re.match(r"FileScan parquet \[([^\]]*)\].*?Location: \S+ paths\)\[([^\]]*)\].*?PushedFilters: \[(.*?)\], ReadSchema", node):
            scans.append((os.path.basename(m[2]).removesuffix(".parquet"), re.sub(r"#\d+L?", "", m[1]), re.sub(r"#\d+L?", "", m[3]) or "none"))
    return {"counts": counts, "scans": scans, "jobs": len(plans)}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from kinfold.plans.catalog import QUERIES
    from kinfold.session import local_session
    spark = local_session(8, 16)
    print("# PLANS: final adaptive physical plans of the registered library queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on). Counts are physical operators "
          "of all plans that ran for the query: its own, and those of the jobs that run while it is built. Every scan is listed, with "
          "the columns read and the filters pushed to Parquet.\n")
    for name in sorted(QUERIES):
        s = summarise(plans_run(lambda: QUERIES[name](spark, sf_dir)))
        print(f"## {name}\n\n- plans: {s['jobs']}; operators: " + ", ".join(f"{k} ×{v}" for k, v in sorted(s["counts"].items())))
        for scan in sorted(set(s["scans"])):
            table, cols, pushed = scan
            print(f"- scan ×{s['scans'].count(scan)} {table} [{cols}] pushed filters: {pushed}")
        print()


if __name__ == "__main__":
    main(sys.argv)
