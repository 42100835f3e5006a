"""Parameterised read queries over the gold marts.

``as_of`` stands for the current instant and defaults to the wall clock. Date bounds
become literals, so they prune the partitions of stored marts.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import scalars as S
from fleetmeter.functions.relational import zip_on_keys
from fleetmeter.functions.scalars import round_half_away as rnd
from fleetmeter.operators import filters as P
from fleetmeter.session import as_of_date


def _total(figure: str) -> Column:
    return S.exact_sum(F.col(figure))


def _mean(figure: str) -> Column:
    """Unweighted mean over mart rows."""
    return S.exact_avg(F.col(figure))


def cost_by_org(cost_attribution: DataFrame, query_date: date | None = None, days: int = 1,
                as_of: datetime | None = None) -> DataFrame:
    """Spend, hours, jobs and mean daily rates per org over a date range."""
    P.check_days(days, 90)
    window = P.date_range_filter(cost_attribution, "job_date", days, query_date, as_of)
    return (
        window.groupBy("org_id")
        .agg(
            rnd(_total("total_cost_usd"), 4).alias("total_cost_usd"),
            rnd(_total("total_gpu_hours"), 2).alias("total_gpu_hours"),
            F.sum("total_jobs").alias("total_jobs"),
            F.sum("succeeded_jobs").alias("succeeded_jobs"),
            F.sum("oom_jobs").alias("oom_jobs"),
            rnd(_mean("oom_rate"), 4).alias("avg_oom_rate"),
            rnd(_mean("success_rate"), 4).alias("avg_success_rate"),
        )
        .orderBy(F.desc_nulls_last("total_cost_usd"), F.asc_nulls_last("org_id"))
    )


def cost_by_model(cost_attribution: DataFrame, query_date: date | None = None, days: int = 7,
                  as_of: datetime | None = None) -> DataFrame:
    """Spend and mean job figures per model architecture and GPU tier."""
    P.check_days(days, 90)
    window = P.date_range_filter(cost_attribution, "job_date", days, query_date, as_of)
    return (
        window.groupBy("model_arch", "gpu_tier")
        .agg(
            rnd(_total("total_cost_usd"), 4).alias("total_cost_usd"),
            rnd(_total("total_gpu_hours"), 2).alias("total_gpu_hours"),
            F.sum("total_jobs").alias("total_jobs"),
            rnd(_mean("avg_cost_per_success_usd"), 4).alias("avg_cost_per_job"),
            rnd(_mean("avg_duration_hours"), 4).alias("avg_duration_hours"),
        )
        .orderBy(
            F.desc_nulls_last("total_cost_usd"), F.asc_nulls_last("model_arch"), F.asc_nulls_last("gpu_tier")
        )
    )


def utilization_hourly(gpu_utilization: DataFrame, query_date: date | None = None, gpu_type: str | None = None,
                       as_of: datetime | None = None) -> DataFrame:
    """One day's hourly utilisation, optionally of one GPU type."""
    day = P.on_date_filter(gpu_utilization, "metric_date", query_date, as_of)
    return (
        P.optional_equality_filters(day, gpu_type=gpu_type)
        .orderBy(F.asc_nulls_last("hour_bucket"), F.asc_nulls_last("gpu_type"), F.asc_nulls_last("rack_id"))
        .select(
            "hour_bucket", "hour_of_day", "gpu_type", "gpu_tier",
            rnd(F.col("avg_gpu_util_pct"), 2).alias("avg_util_pct"),
            rnd(F.col("p95_gpu_util_pct"), 2).alias("p95_util_pct"),
            "active_gpus", "high_util_gpu_count", "idle_gpu_count",
            rnd(F.col("total_power_kw"), 2).alias("total_power_kw"),
            "thermal_warning_count",
        )
    )


def capacity_summary(gpu_utilization: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Recent load per GPU type, with a pressure label."""
    P.check_days(days, 30)
    recent = P.rolling_days_filter(gpu_utilization, "metric_date", days, as_of)
    summary = recent.groupBy("gpu_type", "gpu_tier").agg(
        rnd(_mean("avg_gpu_util_pct"), 2).alias("avg_util_pct"),
        rnd(F.max("p95_gpu_util_pct"), 2).alias("peak_p95_util_pct"),
        rnd(_mean("idle_rate"), 4).alias("avg_idle_rate"),
        rnd(_mean("high_util_rate"), 4).alias("avg_high_util_rate"),
        F.sum("thermal_warning_count").alias("total_thermal_warnings"),
    )
    return summary.withColumn("capacity_pressure", S.capacity_pressure(F.col("avg_util_pct"))).orderBy(
        F.desc_nulls_last("avg_util_pct"), F.asc_nulls_last("gpu_type"), F.asc_nulls_last("gpu_tier")
    )


def active_over_days(gpu_utilization: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Different nodes and GPUs per GPU type over a span, estimated from a mart with ``sketches``.

    The standard error is 1.6 %; counts up to a few hundred are exact but for rare hash collisions.
    """
    P.check_days(days, 90)
    recent = P.rolling_days_filter(gpu_utilization, "metric_date", days, as_of)

    def different(sketch: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(sketch))

    return recent.groupBy("gpu_type", "gpu_tier").agg(
        different("node_sketch").alias("active_nodes"), different("gpu_sketch").alias("active_gpus")
    ).orderBy(F.asc_nulls_last("gpu_type"), F.asc_nulls_last("gpu_tier"))


def sla_by_model(sla: DataFrame, query_date: date | None = None, breaches_only: bool = False,
                 as_of: datetime | None = None) -> DataFrame:
    """One day's latency per model and region, breached ones first."""
    day = P.on_date_filter(sla, "log_date", query_date, as_of)
    return (
        P.optional_equality_filters(day, slo_p99_breached=True if breaches_only else None)
        .orderBy(
            F.desc_nulls_last("slo_p99_breached"), F.desc_nulls_last("p99_latency_ms"),
            F.asc_nulls_last("model_id"), F.asc_nulls_last("region"),
        )
        .select(
            "model_id", "region", "model_size_tier", "total_requests",
            rnd(F.col("cache_hit_rate"), 4).alias("cache_hit_rate"),
            rnd(F.col("p50_latency_ms"), 1).alias("p50_ms"),
            rnd(F.col("p95_latency_ms"), 1).alias("p95_ms"),
            rnd(F.col("p99_latency_ms"), 1).alias("p99_ms"),
            rnd(F.col("p99_latency_ms_non_cached"), 1).alias("p99_ms_non_cached"),
            "slo_p99_breached",
            rnd(F.col("total_cost_usd"), 4).alias("total_cost_usd"),
        )
    )


def sla_trends(sla: DataFrame, model_id: str, region: str | None = None, days: int = 14,
               as_of: datetime | None = None) -> DataFrame:
    """A model's daily latency over the recent past, optionally in one region."""
    P.check_days(days, 90)
    recent = P.rolling_days_filter(sla, "log_date", days, as_of)
    return (
        P.optional_equality_filters(recent, model_id=model_id, region=region)
        .orderBy(F.asc_nulls_last("log_date"), F.asc_nulls_last("region"))
        .select(
            "log_date", "region", "total_requests",
            rnd(F.col("p50_latency_ms"), 1).alias("p50_ms"),
            rnd(F.col("p99_latency_ms"), 1).alias("p99_ms"),
            "cache_hit_rate", "slo_p99_breached",
        )
    )


def dashboard_cost_summary(cost_attribution: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Totals of the recent past; always one row."""
    return P.rolling_days_filter(cost_attribution, "job_date", days, as_of).agg(
        rnd(_total("total_cost_usd"), 2).alias("total_usd"),
        rnd(_total("total_gpu_hours"), 1).alias("total_gpu_hours"),
        F.sum("total_jobs").alias("total_jobs"),
        rnd(_mean("success_rate"), 4).alias("avg_success_rate"),
        rnd(_mean("oom_rate"), 4).alias("avg_oom_rate"),
    )


def dashboard_slo_summary(sla: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """SLO breaches of the recent past; always one row."""
    counts = P.rolling_days_filter(sla, "log_date", days, as_of).agg(
        F.count_if("slo_p99_breached").alias("breach_count"),
        F.count(F.lit(1)).alias("total_model_days"),
    )
    return counts.withColumn(
        "compliance_rate", S.compliance_rate(F.col("breach_count"), F.col("total_model_days"))
    )


def dashboard_summary(cost_attribution: DataFrame, sla: DataFrame, days: int = 7, as_of: datetime | None = None,
                      nested: bool = False) -> DataFrame:
    """Cost, job and SLO figures in one row: flat, or nested by topic."""
    flat = zip_on_keys(
        [dashboard_cost_summary(cost_attribution, days, as_of), dashboard_slo_summary(sla, days, as_of)], []
    ).select(F.lit(f"last_{days}_days").alias("period"), "*")
    if not nested:
        return flat
    return flat.select(
        "period",
        F.struct("total_usd", "total_gpu_hours").alias("cost"),
        F.struct(F.col("total_jobs").alias("total"), "avg_success_rate", "avg_oom_rate").alias("jobs"),
        F.struct("breach_count", "total_model_days", "compliance_rate").alias("slo"),
    )


def top_slo_breaches(sla: DataFrame, n: int = 10, as_of: datetime | None = None) -> DataFrame:
    """Today's worst breaches. Sort and limit run as one bounded top-n, not a full sort."""
    today = P.on_date_filter(sla, "log_date", as_of_date(as_of))
    return (
        P.optional_equality_filters(today, slo_p99_breached=True)
        .select("model_id", "region", "model_size_tier", "p99_latency_ms", "log_date")
        .orderBy(F.desc_nulls_last("p99_latency_ms"), F.asc_nulls_last("model_id"), F.asc_nulls_last("region"))
        .limit(n)
    )
