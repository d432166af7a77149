"""Summarise the executed physical plan of every registered query (markdown).

usage: python tools/show_plans.py [sf_dir] > PLANS.md
Per query: shuffles (hash / range / single-partition exchanges), broadcasts, join
strategies, Python steps, and for each parquet scan the columns read and the
filters pushed into it.  Each DataFrame's own plan is executed first, so the
summaries are AQE's final plans (broadcasts chosen at run time included).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    scans = []
    for ln in lines:
        m = re.search(r"FileScan parquet .*?\[(.*?)\].*?PushedFilters: \[(.*?)\].*?Location: .*?/([a-z_]+)\.parquet", ln)
        if not m:
            m2 = re.search(r"FileScan parquet \[(.*?)\].*?Location: [^\[]*\[file:[^\]]*/([a-z_]+)\.parquet.*?PushedFilters: \[(.*?)\]", ln)
            if m2:
                scans.append((m2.group(2), m2.group(1), m2.group(3)))
            continue
        scans.append((m.group(3), m.group(1), m.group(2)))
    return {
        "hash shuffles": count(r"Exchange hashpartitioning"),
        "range shuffles": count(r"Exchange rangepartitioning"),
        "single-partition": count(r"Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "joins": sorted({m for ln in lines for m in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", ln)}),
        "python": count(r"MapInPandas|ArrowEvalPython|BatchEvalPython"),
        "scans": scans,
    }


def main(argv):
    from corvid.plans.explain import final_plan
    from corvid.plans.registry import all_queries
    from corvid.session import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole lists of pushed filters
    print(f"# Physical plans ({os.path.basename(sf_dir)}, executed, AQE final)\n")
    print("Generated by `tools/show_plans.py`. Columns: hash / range / single-partition "
          "exchanges, broadcasts, join strategies, Python steps; then per parquet scan the "
          "columns read and the filters pushed into the scan.\n")
    print("| query | hash | range | single | bcast | joins | python | scans (columns; pushed filters) |")
    print("|---|---|---|---|---|---|---|---|")
    for name, q in all_queries().items():
        s = summarise(final_plan(q.build(spark, sf_dir)))
        scans = "<br>".join(f"{t}: {re.sub(r'#\d+L?', '', cols)}; {re.sub(r'#\d+L?', '', pf) or '-'}"
                            for t, cols, pf in s["scans"])
        print(f"| {name} | {s['hash shuffles']} | {s['range shuffles']} | {s['single-partition']} | "
              f"{s['broadcasts']} | {', '.join(s['joins']) or '-'} | {s['python']} | {scans} |")


if __name__ == "__main__":
    main(sys.argv[1:])
