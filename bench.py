"""Headline timings: base tables, rollups, one-pass screen, one GBT fit and two searches.

Runs each query fully on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line. Each query is executed to completion with the ``noop`` sink, so the
whole plan runs on the executors and nothing is collected to the driver. Every query runs
``$BENCH_RUNS`` times (default 2) and reports its fastest run; the first-run total (cold JVM,
code generation, file cache) is reported as ``cold_total``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.plans import catalog  # noqa: E402
from orderlens.session import local_session  # noqa: E402

HEADLINE = (
    "basetable_train",
    "basetable_holdout",
    "pearson_screen",
    "order_money_rollup",
    "pivot_payments",
    "pivot_wide",
    "order_shape_rollup",
    "dedupe_by_key",
    "profile_columns",
    "join_back_money",
    "model_gbt",
    "signal_lr",
    "signal_rf",
)


def _sf(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="orderlens-bench")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    catalog.REGISTRY["row_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings, cold = {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            catalog.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        timings[name] = round(min(times), 3)
        cold[name] = round(times[0], 3)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": _sf(sf_dir),
        "runs": runs,
        "cold_total": round(sum(cold.values()), 3),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
