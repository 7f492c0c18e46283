"""Headline queries, timed: one JSON line.

Every query runs twice in one session. ``queries`` and ``value`` are the second
runs, ``cold`` the first ones, which include compiling the generated code.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from checks.queries import QUERIES
from shelflens.session import build_session

HEADLINES = [
    "snapshot_valid",
    "restock_invalid",
    "inventory_fact",
    "quarantine_error_types",
    "rows_with_suggestion",
    "units_fact",
    "product_pairs",
    "affinity_scores",
    "affinity_scores_distinct",
    "top_affinities",
    "enriched_refunds",
    "fraud_patterns",
    "refund_amount_stats",
    "fraud_flags",
    "suspicious_customers",
    "customer_segments",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold, warm = {}, {}
    for name in HEADLINES:
        cold[name] = seconds(name)
        warm[name] = seconds(name)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
