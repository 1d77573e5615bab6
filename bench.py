"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Every query runs to completion through
the ``noop`` sink (full execution, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ml_scoring", "anomaly_scores", "detection_rule", "enrichment", "findings_upsert_latest",
    "finding_documents", "bi_rollup", "bi_rollup_topn", "top_device_types", "cdc_latest_state",
    "running_cvss_range", "cep_burst_alert", "high_risk_5min", "check_pk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from secflow.plans import catalog
    from secflow.session import build_session, release_materialized

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    # Warm-up (JVM, class loading, code paths) outside the timings: the flagship on the smallest
    # sibling scale factor when present, then a cheap scan of the benchmark tables.
    small = os.path.join(os.path.dirname(os.path.abspath(sf_dir)), "sf0.001")
    if os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(sf_dir):
        for name in ("ml_scoring", "bi_rollup"):
            catalog.QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    catalog.QUERIES["agg_cves_per_tenant"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    release_materialized(spark)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
