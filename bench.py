"""Benchmark the five headline queries end to end.

Runs q05, q20, q25, q26 and q28 on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8). Each query is
run ``$BENCH_REPEATS`` times (default 3) in one warm session and its median
wall time is reported; ``value`` is the sum of the medians. Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import kept_tables, local_session  # noqa: E402

HEADLINE = ("q05", "q20", "q25", "q26", "q28")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="quarry-bench")
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    times: dict[str, float | None] = {}
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        runs = []
        try:
            for _ in range(repeats):
                t0 = time.perf_counter()
                with kept_tables(spark):
                    rows[name] = len(QUERIES[name](spark, sf_dir).collect())
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # report and go on: one JSON line either way
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(match.group(1)) if match else None,
        "cpus": cpus,
        "repeats": repeats,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
