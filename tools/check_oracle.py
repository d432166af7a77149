"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/check_oracle.py [--json OUT] [sf_dir] [name ...]
Comparison: row count, column names, column types (mapped), and the multiset of
rows (exact values, order-insensitive).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _sp_type(t):
    if t.startswith("array<") and t.endswith(">"):
        return _sp_type(t[6:-1]) + "[]"
    if t.startswith("decimal"):
        return t.upper()
    return TYPE_MAP.get(t, t)


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "__float__") and not isinstance(v, (int, float, bool)):
        return float(v)
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    df = q.build(spark, sf_dir)
    rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    cols = df.columns
    sp_types = [_sp_type(t) for _, t in df.dtypes]
    t1 = time.time()
    if not q.sql:
        return dict(name=name, status="rows-only", rows=len(rows), spark_s=round(t1 - t0, 2))
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    dtypes = [str(d[1]) for d in res.description]
    t2 = time.time()
    issues = []
    if sorted(cols) != sorted(dcols):
        issues.append(f"cols spark={cols} duck={dcols}")
    else:
        order = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in order) for r in drows]
        dtypes = [dtypes[i] for i in order]
        if sp_types != dtypes:
            issues.append(f"types spark={sp_types} duck={dtypes}")
    if len(rows) != len(drows):
        issues.append(f"rows spark={len(rows)} duck={len(drows)}")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a, b = sorted(rows, key=key), sorted(drows, key=key)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        issues.append(f"values differ, e.g. {diff}")
    return dict(name=name, status="ok" if not issues else "MISMATCH", rows=len(rows),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2), issues=issues)


def main(argv):
    import json

    from corvid.plans.registry import all_queries
    from corvid.session import local_session
    out_json = None
    if argv[:1] == ["--json"]:
        out_json, argv = argv[1], argv[2:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    report = []
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for name, q in all_queries().items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, status="ERROR", issues=[repr(e)[:800]])
        bad += r["status"] in ("MISMATCH", "ERROR")
        report.append(r)
        print(r, flush=True)
    print("failures:", bad)
    if out_json:
        with open(out_json, "w") as f:
            json.dump({"sf_dir": sf_dir, "failures": bad, "queries": report}, f, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
