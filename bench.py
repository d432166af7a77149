"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

query runs once to warm up, then ``BENCH_RUNS`` (default 3) times; the
median wall time is reported (``queries``), and separately the part spent
building the DataFrame (``build``: eager steps such as broadcast size checks,
hot-key detection or model fits).  A run executes the whole plan through Spark's
``noop`` sink (nothing is collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

def main() -> None:
    from corvid.plans.registry import all_queries
    from corvid.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="corvid-bench")
    queries = all_queries()
    names = sys.argv[1:] or list(queries)
    results: dict[str, float] = {}
    builds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        build = queries[name].build

        def once() -> tuple[float, float]:
            t0 = time.perf_counter()
            df = build(spark, sf_dir)  # may run eager steps: size checks, model fits
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0, t1 - t0

        try:
            once()  # warm-up
            timings = [once() for _ in range(runs)]
            results[name] = round(statistics.median(t for t, _ in timings), 3)
            builds[name] = round(statistics.median(b for _, b in timings), 3)
        except Exception as e:  # keep the JSON line: record the failure
            failed[name] = repr(e)[:300]
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "runs": runs,
                      "build": builds, "failed": failed}))


if __name__ == "__main__":
    main()
