"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

As in a pipeline run, the shared stages (processed, annotated and joined tables) are built once; that
time is reported as ``shared_stages``. Each headline query then runs three times into Spark's no-op sink
(nothing is collected to the driver); the median counts. ``value`` is the total: shared stages + all queries. ``cold_sec`` times two
queries from raw with nothing shared, and ``pipeline_sec`` one full publishing run (every table written
as parquet). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_orders",
    "rule_results_orders",
    "rule_results_customers",
    "rule_results_delivery",
    "quality_summary",
    "analytics_main",
    "segment_analysis",
    "monthly_performance",
    "delivery_analysis",
    "customer_ranking",
    "payment_analysis",
    "kpi_summary",
    "freshness_events",
    "lineitem_rule_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidemark.plans import queries as Q
    from tidemark.plans.pipeline import RunConfig, run
    from tidemark.session import local_session, shared_folder
    from tidemark.sources import fixtures

    spark = local_session(cpus=cpus, shuffle_partitions=max(cpus, 8), app="tidemark-bench")
    qs = Q.queries()

    # warm-up (JVM, codegen caches) on the smallest folder, not timed
    Q.clear_flows()
    qs["segment_analysis"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    Q.clear_flows()
    t0 = time.perf_counter()
    flow = Q.flow(spark, sf_dir)
    flow.check_all()
    flow.joined
    times["shared_stages"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        samples = []
        for _ in range(3):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)

    cold: dict[str, float] = {}
    for name in ("rule_results_orders", "segment_analysis"):
        Q.clear_flows()
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[name] = round(time.perf_counter() - t0, 3)

    Q.clear_flows()
    out = f"{shared_folder(spark).rstrip('/')}/tidemark/bench-{uuid.uuid4().hex[:12]}"
    t0 = time.perf_counter()
    report = run(spark, fixtures.raw_tables(spark, sf_dir), out, RunConfig(as_of=Q.AS_OF, batch_id="bench"))
    report.collect()
    pipeline = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_sec": cold,
        "pipeline_sec": pipeline,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
