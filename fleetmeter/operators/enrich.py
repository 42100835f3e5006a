"""Silver enrichment: raw records in, typed and partition-ready records out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import scalars as S
from fleetmeter.operators import dedup as D
from fleetmeter.session import as_of_column


def ingest_stamp(df: DataFrame, as_of: datetime | None = None, name: str = "_ingested_at") -> DataFrame:
    return df.withColumn(name, as_of_column(as_of))


def date_hour_parts(df: DataFrame, ts: str, date_name: str, hour_name: str | None = None) -> DataFrame:
    """Calendar date, and optionally hour, of a timestamp."""
    parts = {date_name: F.to_date(ts)}
    if hour_name:
        parts[hour_name] = F.hour(ts)
    return df.withColumns(parts)


def silver_jobs(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Deduplicated job events with price, outcome, GPU hours and partition date."""
    enriched = D.dedup_jobs(raw).withColumns(
        {
            "is_late_arrival": S.lenient_boolean(F.col("is_late_arrival")),
            "price_per_gpu_hour": S.price_per_gpu_hour(F.col("gpu_type")),
            "is_success": S.exited_cleanly(F.col("exit_code")),
            "gpu_hours": F.col("duration_hours") * F.col("gpu_count"),
        }
    )
    return ingest_stamp(date_hour_parts(enriched, "started_at", "job_date"), as_of)


def silver_inference(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Deduplicated request logs; takes the batch files or the stream table alike."""
    enriched = D.dedup_inference(raw).withColumns(
        {
            "cache_hit": S.lenient_boolean(F.col("cache_hit")),
            "is_success": S.request_succeeded(F.col("status_code")),
        }
    )
    return ingest_stamp(date_hour_parts(enriched, "timestamp", "log_date", "log_hour"), as_of)


def silver_node_metrics(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Node readings, one per GPU and instant."""
    return ingest_stamp(date_hour_parts(D.dedup_node_metrics(raw), "timestamp", "metric_date"), as_of)
