"""Time the headline queries and print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set below).
Each query is executed in full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "drift_report", "psi_by_feature", "ks_by_feature", "validation_checks", "split_members",
    "scaler_params", "average_precision", "roc_auc", "pr_curve", "canonical_metrics", "feature_ap",
    "topk_table", "alerts_topk", "alerts_per_batch", "best_run", "promotion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from vigil.plans.queries import QUERIES
    from vigil.session import local_session
    wanted = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="vigil-bench")
    # warm-up on the tiny smoke tables: JVM JIT, codegen caches, parquet footers
    for q in ("roc_auc", "drift_report", "validation_checks"):
        QUERIES[q](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for q in wanted:
        if q not in QUERIES:
            continue
        t0 = time.perf_counter()
        QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[q] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))


if __name__ == "__main__":
    main()
