"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON
line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.

Each query is fully executed with a ``noop`` write (every row computed,
nothing collected to the driver).  An untimed warm-up runs every query once
on the sf0.001 tables first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    from tabkit.plans.registry import all_queries
    from tabkit.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                        app_name="tabkit-bench", extra={"spark.ui.showConsoleProgress": "false"})
    qs = {n: q for n, q in all_queries().items() if (q.bench and not only) or n in only}
    # warm-up (untimed): every timed query once on the smallest tables, so JIT
    # compilation, codegen caches and Python workers are not billed to the
    # first timed query
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for q in qs.values():
        q.build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, q in qs.items():
        t0 = time.perf_counter()
        q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
