"""Read the plan a DataFrame really ran: AQE's final physical plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

_TREE = " :|"


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(_TREE))


def final_plan(df: DataFrame, execute: bool = True) -> str:
    """This DataFrame's physical plan after AQE re-planning.

    ``execute`` runs the DataFrame's own query (not a copy, as ``df.write`` or
    ``df.count()`` would) so that every adaptive plan in it is final.  The
    "Initial Plan" subtrees, at the top and inside subqueries, are dropped.
    """
    qe = df._jdf.queryExecution()
    if execute:
        qe.toRdd().count()
    out, skip_below = [], None
    for line in qe.executedPlan().toString().splitlines():
        d = _depth(line)
        if skip_below is not None:
            if d > skip_below:
                continue
            skip_below = None
        if "== Initial Plan ==" in line:
            skip_below = d
            continue
        out.append(line)
    return "\n".join(out)
