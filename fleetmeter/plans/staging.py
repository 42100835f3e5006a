"""Staging and intermediate views between silver and the marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import scalars as S

# Staged columns and their types.
STAGED_JOB_TYPES = {
    "job_id": "string", "org_id": "string", "user_id": "string",
    "gpu_type": "string", "gpu_count": "int", "price_per_gpu_hour": "double",
    "framework": "string", "model_arch": "string", "dataset_size_gb": "double",
    "started_at": "timestamp", "ended_at": "timestamp",
    "duration_hours": "double", "gpu_hours": "double", "cost_usd": "double",
    "exit_code": "int", "is_success": "boolean", "is_late_arrival": "boolean",
    "job_date": "date", "_ingested_at": "timestamp",
}
STAGED_REQUEST_TYPES = {
    "request_id": "string", "org_id": "string", "user_id": "string", "model_id": "string", "region": "string",
    "status_code": "int", "cache_hit": "boolean", "is_success": "boolean",
    "input_tokens": "int", "output_tokens": "int", "total_tokens": "int",
    "latency_ms": "double", "cost_usd": "double",
    "requested_at": "timestamp", "log_date": "date", "log_hour": "int",
}


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items() if c in df.columns))


def stg_jobs(silver_jobs: DataFrame) -> DataFrame:
    """Typed jobs that have a start time."""
    return _typed(silver_jobs.filter(F.col("started_at").isNotNull()), STAGED_JOB_TYPES)


def stg_inference(silver_inference: DataFrame) -> DataFrame:
    """Typed requests that have a time, which is renamed ``requested_at``."""
    timed = silver_inference.filter(F.col("timestamp").isNotNull())
    return _typed(timed.withColumnRenamed("timestamp", "requested_at"), STAGED_REQUEST_TYPES)


def stg_node_metrics(silver_node_metrics: DataFrame) -> DataFrame:
    """Typed readings with their hour, date and GPU tier."""
    at = F.col("timestamp").cast("timestamp")
    readings = ("gpu_util_pct", "memory_util_pct", "temp_celsius", "power_watts")
    return silver_node_metrics.filter(F.col("timestamp").isNotNull()).select(
        at.alias("metric_ts"),
        F.date_trunc("hour", at).alias("hour_bucket"),
        F.to_date(at).alias("metric_date"),
        "node_id", "gpu_id", "rack_id", "gpu_type",
        S.gpu_tier(F.col("gpu_type")).alias("gpu_tier"),
        *(F.col(c).cast("double").alias(c) for c in readings),
    )


def int_job_costs(staged_jobs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Jobs with billable hours, recomputed cost, status and GPU tier.

    The stored ``cost_usd`` is replaced: late jobs have none, platform faults are free.
    """
    exit_code, ended_at = F.col("exit_code"), F.col("ended_at")
    hours = S.billable_hours(exit_code, ended_at, F.col("duration_hours"), F.col("started_at"), as_of)
    return staged_jobs.select(
        "job_id", "org_id", "user_id", "gpu_type", "gpu_count", "framework", "model_arch", "dataset_size_gb",
        "started_at", "ended_at", "exit_code", "is_success", "is_late_arrival", "job_date",
        hours.alias("billable_hours"),
        "gpu_hours", "price_per_gpu_hour",
        S.job_cost(exit_code, hours, F.col("gpu_count"), F.col("price_per_gpu_hour")).alias("cost_usd"),
        S.job_status(exit_code, ended_at).alias("job_status"),
        S.gpu_tier(F.col("gpu_type")).alias("gpu_tier"),
    )
