"""Timings of the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the number of cores. Marts run
from the raw tables through silver; reads run on stored marts, as they would in service.
Each query runs once to warm up, then into the noop sink: once, or ``BENCH_RUNS`` times when it is
quick enough for noise to matter; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry as R  # noqa: E402
from fleetmeter.plans import reads  # noqa: E402
from fleetmeter.session import build_session  # noqa: E402
from fleetmeter.sources import tables  # noqa: E402

FROM_RAW = [
    "dedup_jobs", "dedup_node_metrics", "silver_jobs", "silver_inference", "silver_node_metrics",
    "merge_completions", "upsert_merge", "int_job_costs",
    "cost_attribution", "gpu_utilization_hourly", "job_performance_sla",
    "silver_jobs_gate", "test_unique", "parse_stream_payload", "read_job_events", "upsert_jobs",
    "inference_stream_ingest", "compact_zorder",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = R.Inputs(spark, sf_dir)

    def stored(df, partition_by):
        return tables.write_partitioned_overwrite(df, inputs.scratch("bench-gold"), [partition_by])

    cost = stored(inputs.cost(), "job_date")
    util = stored(inputs.utilization(), "metric_date")
    sla = stored(inputs.sla(), "log_date")
    on_gold = {
        "read_cost_by_org": lambda: reads.cost_by_org(cost, R.COST_DATE, 3),
        "read_cost_by_model": lambda: reads.cost_by_model(cost, R.COST_DATE),
        "read_utilization_hourly": lambda: reads.utilization_hourly(util, R.UTILIZATION_DATE),
        "read_capacity_summary": lambda: reads.capacity_summary(util, as_of=R.CAPACITY_AS_OF),
        "read_sla_by_model": lambda: reads.sla_by_model(sla, R.COST_DATE),
        "read_sla_trends": lambda: reads.sla_trends(sla, R.TREND_MODEL, as_of=R.AS_OF),
        "read_dashboard_summary": lambda: reads.dashboard_summary(cost, sla, as_of=R.AS_OF),
        "read_top_slo_breaches": lambda: reads.top_slo_breaches(sla, as_of=R.SLO_AS_OF),
    }
    registered = R.queries()
    plans = {name: (lambda q=registered[name]: q(spark, sf_dir)) for name in FROM_RAW} | on_gold

    def timed(plan) -> float:
        started = time.perf_counter()
        plan().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name, plan in plans.items():
        timed(plan)
        taken = [timed(plan)]
        while len(taken) < runs and taken[0] < 2:
            taken.append(timed(plan))
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
