"""Benchmark the headline jobs and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced to completion with the ``noop`` sink (full
computation, nothing collected to the driver) after one warm-up run of
the flagship.  A query's time is the best of ``BENCH_REPEATS`` runs (the
first run of a new plan shape pays code generation); ``value`` is the sum
of the per-query wall-clock seconds, DataFrame construction included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vaultmart.plans.queries import QUERIES  # noqa: E402
from vaultmart.session import get_spark  # noqa: E402
from vaultmart.sources.proxy import SCAN_PARTITIONS  # noqa: E402

HEADLINE = [
    "m02_payment_leakage_rate_by_provider_year",   # hash + vault loaders + fact + ratio metric
    "c06_satellite_history_two_batches",           # satellite history load, second batch
    "e13_fact_readmission",                        # range self-join without pair explosion
    "e18_fact_medication_adherence",               # high-cardinality aggregate
    "e04_fact_drg_reimbursement_variance",         # global benchmark + broadcast one-row join
    "i09_chargeback",                              # interval (price validity) join + aggregate
    "f12_multi_metric_by_year",                    # three facts, null-safe full outer
    "i12_budget_admission",                        # sequential ledger per (feature, day)
    "i15_screen_documents",                        # regex guardrails over whole documents
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    # the bench tables are one row group each, so a scan would be one task
    spark = get_spark(f"local[{cpus}]", max(8, 2 * cpus), app_name="vaultmart-bench", extra={SCAN_PARTITIONS: str(cpus)})
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
