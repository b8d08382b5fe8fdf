"""Time the headline queries; prints one JSON line.

Every query computes its own pipeline: nothing is shared between timings. The
session is warmed up once on the same tables.
"""

from __future__ import annotations

import json
import os
import time

from ledgerlink.plans.queries import QUERIES, forget_results
from ledgerlink.session import local_session

HEADLINES = (
    "exact_matches",
    "token_overlap_pairs",
    "amount_band_pairs",
    "top_k_candidates",
    "top_k_candidates_hot",
    "rule_decisions",
    "greedy_assignment",
    "matched_report",
    "erp_exceptions",
    "category_prf",
    "run_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus=cpus, shuffle_partitions=cpus)
    QUERIES["matched_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        forget_results()
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    ledger_rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total time of the headline reconciliation queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "ledger_rows": ledger_rows,
                "pipeline_ledger_rows_per_sec": round(ledger_rows / seconds["matched_report"]),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
