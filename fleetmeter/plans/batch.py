"""The daily batch: raw files to silver, through the gate, to gold."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter import schemas
from fleetmeter.operators import dedup, enrich, merge, quality
from fleetmeter.operators.maintenance import optimize_tables
from fleetmeter.plans import incremental as by_date
from fleetmeter.plans import marts, staging
from fleetmeter.session import at_once, scratch_scope, sized_shuffles, spill_to_table
from fleetmeter.sources import files, tables

# Where each raw input lies below the bronze root.
BRONZE_FOLDERS = {
    "job_events": "job_events",
    "job_completions": "job_completions",
    "inference_logs": "inference_logs",
    "node_metrics": "node_metrics",
}


class BatchResult(NamedTuple):
    counts: Mapping[str, int]
    checks: DataFrame
    promoted: bool
    silver_tests: DataFrame
    gold_tests: DataFrame | None
    malformed: Mapping[str, int] | None = None


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of in a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def build_silver(spark: SparkSession, bronze: str, silver: str, as_of: datetime | None = None,
                 overwrite: bool = True, fmt: str = tables.DEFAULT_FORMAT,
                 requests: DataFrame | None = None) -> dict[str, int]:
    """Write the three silver tables and apply late completions; returns their row counts.

    A full load merges completions before its one write of the jobs table. ``requests``
    replaces the inference log files, such as the table that the stream appends to; of its
    columns those of the log are taken.
    """
    at = {name: f"{bronze}/{folder}" for name, folder in BRONZE_FOLDERS.items()}
    raw = {
        "job_events": files.read_job_events(spark, at["job_events"]),
        "job_completions": files.read_job_completions(spark, at["job_completions"]),
        "node_metrics": files.read_node_metrics(spark, at["node_metrics"]),
    }
    if requests is None:
        raw["inference_logs"] = files.read_inference_logs(spark, at["inference_logs"])
    return _silver_from(spark, raw, silver, as_of, overwrite, fmt, requests)


def build_checked_silver(spark: SparkSession, bronze: str, silver: str, quarantine: str, as_of: datetime | None = None,
                         overwrite: bool = True, fmt: str = tables.DEFAULT_FORMAT,
                         requests: DataFrame | None = None) -> tuple[dict[str, int], dict[str, int]]:
    """``build_silver`` with malformed lines set aside; returns its counts and the malformed lines of each input.

    Silver is the same but for rows that were made from lines without a readable key.
    """
    with scratch_scope(spark):
        skip = () if requests is None else ("inference_logs",)
        raw, bad = set_aside(spark, bronze, quarantine, as_of, skip, fmt)
        return _silver_from(spark, raw, silver, as_of, overwrite, fmt, requests), bad


def _silver_from(spark: SparkSession, raw: Mapping[str, DataFrame], silver: str, as_of: datetime | None,
                 overwrite: bool, fmt: str, requests: DataFrame | None) -> dict[str, int]:
    if requests is None:
        raw_inference = raw["inference_logs"]
    else:
        raw_inference = requests.select(*T.StructType.fromDDL(schemas.INFERENCE_LOG).names)
    completions = dedup.dedup_completions(raw["job_completions"])

    with sized_shuffles(raw["job_events"], raw["job_completions"], raw_inference, raw["node_metrics"]):
        jobs, n_jobs = _counted(enrich.silver_jobs(raw["job_events"], as_of), "jobs")
        if overwrite or not tables.table_exists(spark, f"{silver}/jobs", fmt):
            merge.upsert_jobs(spark, merge.merge_completions(jobs, completions, as_of), f"{silver}/jobs", True, fmt)
        else:
            merge.upsert_jobs(spark, jobs, f"{silver}/jobs", False, fmt)
            merge.merge_completions_table(spark, f"{silver}/jobs", completions, as_of, fmt=fmt)
        inference, n_inference = _counted(enrich.silver_inference(raw_inference, as_of), "inference")
        merge.upsert_inference(spark, inference, f"{silver}/inference", overwrite, fmt)
        metrics, n_metrics = _counted(enrich.silver_node_metrics(raw["node_metrics"], as_of), "node_metrics")
        merge.upsert_node_metrics(spark, metrics, f"{silver}/node_metrics", overwrite, fmt)
    seen = {"jobs": n_jobs, "inference": n_inference, "node_metrics": n_metrics}
    return {name: o.get["rows"] for name, o in seen.items()}


RAW_INPUTS = {
    "job_events": files.JOB_EVENTS,
    "job_completions": files.JOB_COMPLETIONS,
    "inference_logs": files.INFERENCE_LOGS,
    "node_metrics": files.NODE_METRICS,
}


def set_aside(spark: SparkSession, bronze: str, quarantine: str, as_of: datetime | None = None,
              skip: Collection[str] = (), fmt: str = tables.DEFAULT_FORMAT) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Parse the raw inputs once; returns their readable rows and the number of malformed lines of each.

    The quarantine table is replaced by the malformed lines of this run: input, file, text, kept, _ingested_at. They
    are found in the stored parse by the statistics of a column that is NULL nearly everywhere, so the second output
    costs next to nothing.
    """
    checked = {}
    for name, raw in RAW_INPUTS.items():
        if name not in skip:
            checked[name] = files.read_checked(spark, f"{bronze}/{BRONZE_FOLDERS[name]}", raw)
    lines = [files.malformed(df, RAW_INPUTS[n]).withColumn("input", F.lit(n)) for n, df in checked.items()]
    bad = enrich.ingest_stamp(reduce(DataFrame.unionByName, lines), as_of)
    stored = tables.write_partitioned_overwrite(bad.select("input", "file", "text", "kept", "_ingested_at"), quarantine, (), fmt)
    found = {r["input"]: r["count"] for r in stored.groupBy("input").count().collect()}
    return {n: files.readable(df, RAW_INPUTS[n]) for n, df in checked.items()}, {n: found.get(n, 0) for n in checked}


def staging_views(spark: SparkSession, silver: str, fmt: str = tables.DEFAULT_FORMAT) -> dict[str, DataFrame]:
    """Register staging as temporary views over the silver files as they are now.

    Call again after silver was rewritten: a view holds on to the files it was made from.
    """
    stored = {n: tables.scan_table(spark, f"{silver}/{n}", fmt) for n in ("jobs", "inference", "node_metrics")}
    views = {
        "stg_jobs": staging.stg_jobs(stored["jobs"]),
        "stg_inference": staging.stg_inference(stored["inference"]),
        "stg_node_metrics": staging.stg_node_metrics(stored["node_metrics"]),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def materialize_gold(spark: SparkSession, silver: str, gold: str, as_of: datetime | None = None,
                     fmt: str = tables.DEFAULT_FORMAT) -> dict[str, DataFrame]:
    """Staging as temporary views; the intermediate table and the marts as stored tables.

    Job costs are stored once and feed the mart from there, while the other two marts are made
    beside them. Every table is partitioned by its date, the column all reads filter on.
    """
    views = staging_views(spark, silver, fmt)
    job_costs = staging.int_job_costs(views["stg_jobs"], as_of)
    utilization = marts.gpu_utilization_hourly(views["stg_node_metrics"])
    sla = marts.job_performance_sla(views["stg_inference"])

    def store(df: DataFrame, name: str, partition_by: str) -> DataFrame:
        return tables.write_partitioned_overwrite(df, f"{gold}/{name}", [partition_by], fmt)

    def store_costs() -> tuple[DataFrame, DataFrame]:
        costs = store(job_costs, "int_job_costs", "job_date")
        return costs, store(marts.cost_attribution(costs), "cost_attribution", "job_date")

    with sized_shuffles(job_costs, utilization, sla):
        (costs, cost), stored_utilization, stored_sla = at_once(
            spark, store_costs,
            lambda: store(utilization, "gpu_utilization_hourly", "metric_date"),
            lambda: store(sla, "job_performance_sla", "log_date"),
        )
    return {"int_job_costs": costs, "cost_attribution": cost, "gpu_utilization_hourly": stored_utilization,
            "job_performance_sla": stored_sla}


def _no_failures(tests: DataFrame) -> bool:
    return tests.where("failures > 0").isEmpty()


def run_batch(spark: SparkSession, bronze: str, silver: str, gold: str, as_of: datetime | None = None,
              overwrite: bool = True, optimize: bool = True, fmt: str = tables.DEFAULT_FORMAT,
              requests: DataFrame | None = None, quarantine: str | None = None, incremental: bool = False) -> BatchResult:
    """Silver, gate, gold, column tests, compaction. A failed gate leaves gold untouched, and a
    failed test leaves all tables uncompacted. With a ``quarantine`` path malformed lines are set
    aside there, and the result has their number."""
    bad = None
    if quarantine is None:
        counts = build_silver(spark, bronze, silver, as_of, overwrite, fmt, requests)
    else:
        counts, bad = build_checked_silver(spark, bronze, silver, quarantine, as_of, overwrite, fmt, requests)
    stored = {n: tables.scan_table(spark, f"{silver}/{n}", fmt) for n in ("jobs", "inference")}
    checks = spill_to_table(quality.silver_jobs_gate(stored["jobs"]), "gate")
    silver_tests = spill_to_table(quality.run_column_tests(stored, quality.SILVER_TESTS), "silver-tests")

    def promote() -> dict[str, DataFrame]:
        if not incremental or fmt != tables.DEFAULT_FORMAT:
            return materialize_gold(spark, silver, gold, as_of, fmt)
        staging_views(spark, silver, fmt)
        by_date.refresh_gold(spark, silver, gold, as_of)
        return by_date.stored_gold(spark, gold)

    gold_tables = quality.promote_if_passed(checks, promote)
    if gold_tables is None:
        return BatchResult(counts, checks, False, silver_tests, None, bad)
    gold_tests = spill_to_table(quality.run_column_tests(gold_tables, quality.GOLD_TESTS), "gold-tests")
    if optimize and _no_failures(silver_tests) and _no_failures(gold_tests):
        optimize_tables(spark, silver, gold, fmt)
        staging_views(spark, silver, fmt)
    return BatchResult(counts, checks, True, silver_tests, gold_tests, bad)
