"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
{name: seconds}, "sf"}.  Each job is timed $BENCH_RUNS times (default 2)
after an untimed warm-up on sf0.001, and the best run is reported.
Shuffle partitions default to one per core ($BENCH_SHUFFLE_PARTITIONS):
at this scale more partitions only add per-task and state-store overhead.  Every job is forced to completion with the
``noop`` sink (no collect to the driver); session start-up and the one-off
writing of the fixture topic are not timed.

    BENCH_SF_DIR=/root/testdata/sf0.01 python bench.py
    BENCH_QUERIES=fraud_jobs,dashboard python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))     # best of N timed runs per job


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _jobs(spark, sf):
    from fraudlens.plans import queries as Q

    from fraudlens.plans.jobs import publish_script
    from fraudlens.session import shared_dir
    from fraudlens.sources.envelope import files
    topics = Q.fixture_topics(spark, sf)

    def report_job(topic, set_name):
        # The reference's report script: topic -> decode -> reports -> topics.
        def go():
            publish_script(spark, topics, topic, set_name, files(shared_dir(spark, "bench-out")))
        return go

    def queries(*names):
        def go():
            for n in names:
                _run(Q.QUERIES[n](spark, sf))
        return go

    def dashboard_job():
        from fraudlens.operators.dashboard import dashboard_tables
        for df in dashboard_tables(Q.sc(spark, sf)).values():
            _run(df)

    return {
        # The four report scripts, each one job from its topic to its topics.
        "ecommerce_fraud": report_job(Q.TX_TOPIC, "ecommerce_fraud"),
        "ecommerce_summary": report_job(Q.TX_TOPIC, "ecommerce_summary"),
        "supply_fraud": report_job(Q.SC_TOPIC, "supply_fraud"),
        "supply_summary": report_job(Q.SC_TOPIC, "supply_summary"),
        # All six dashboard tables over the whole supply table (3 passes).
        "dashboard": dashboard_job,
        # Topic -> JSON decode (narrow) -> report; and the full decode.
        "decode_fraud_category": queries("decode_narrow_fraud_category"),
        "decode_transactions": queries("decode_transactions"),
        "fused_all_dimensions": queries("fraud_all_dimensions"),
        "publish_readback": queries("publish_readback"),
        "stream_fraud_category": queries("stream_fraud_category"),
        "wide_upsert": queries("wide_upsert"),
        "auc_fraud_probability": queries("auc_fraud_probability"),
    }


def main() -> int:
    from fraudlens.plans import queries as Q
    from fraudlens.session import get_session
    spark = get_session(f"local[{CPUS}]", app="fraudlens-bench",
                        conf={"spark.sql.shuffle.partitions": os.environ.get(
                                  "BENCH_SHUFFLE_PARTITIONS", CPUS),
                              "spark.driver.memory": "16g"})
    wanted = [w for w in os.environ.get("BENCH_QUERIES", "").split(",") if w]
    # Untimed warm-up (JIT, codegen and Python workers) on the smallest
    # data folder, then the one-off writing of the fixture topic.
    warm = SF_DIR.rstrip("/").rsplit("/", 1)[0] + "/sf0.001"
    if os.path.isdir(warm) and warm != SF_DIR:
        for fn in _jobs(spark, warm).values():
            fn()
    Q.fixture_topics(spark, SF_DIR)
    jobs = _jobs(spark, SF_DIR)
    times = {}
    for name, fn in jobs.items():
        if wanted and name not in wanted:
            continue
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else SF_DIR}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
