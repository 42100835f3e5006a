"""The three gold marts.

Sums, counts and extrema combine map-side, so a hot group costs one row per task.
Percentiles come from rank selection (see ``functions.percentiles``).
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions import scalars as S
from fleetmeter.functions.percentiles import (
    Percentile,
    approx_percentile_columns,
    select_percentiles,
)
from fleetmeter.functions.relational import zip_on_keys
from fleetmeter.functions.scalars import round_half_away as rnd
from fleetmeter.operators.filters import successful_requests, with_job_date

Method = Literal["exact", "approx"]

COST_GRAIN = ["job_date", "org_id", "user_id", "model_arch", "gpu_tier", "gpu_type", "framework"]
UTILIZATION_GRAIN = ["hour_bucket", "metric_date", "gpu_type", "gpu_tier", "rack_id"]
SLA_GRAIN = ["log_date", "model_id", "region"]

SKETCHES = ["node_sketch", "gpu_sketch"]
SKETCH_BITS = 12  # 4,096 registers, at most 4 KB a sketch; standard error 1.6 %


def cost_attribution(job_costs: DataFrame, key_format: tuple[str, str] = S.KEY_FORMAT_PACKAGE) -> DataFrame:
    """Daily spend, volume and outcome rates per org, user, architecture and GPU."""

    def having(status: str) -> Column:
        return F.col("job_status") == status

    jobs = with_job_date(job_costs)
    daily = jobs.groupBy(*COST_GRAIN).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(having("succeeded")).alias("succeeded_jobs"),
        F.count_if(having("oom_killed")).alias("oom_jobs"),
        F.count_if(having("failed")).alias("failed_jobs"),
        F.count_if(having("running")).alias("running_jobs"),
        rnd(S.exact_sum(F.col("cost_usd")), 4).alias("total_cost_usd"),
        rnd(S.exact_sum(F.col("gpu_hours")), 4).alias("total_gpu_hours"),
        rnd(S.exact_avg(F.when(having("succeeded"), F.col("cost_usd"))), 4).alias("avg_cost_per_success_usd"),
        rnd(S.exact_avg(F.when(having("succeeded"), F.col("billable_hours"))), 4).alias("avg_duration_hours"),
        rnd(F.max("billable_hours"), 4).alias("max_duration_hours"),
    )
    ended = F.col("total_jobs") - F.col("running_jobs")
    return daily.select(
        S.surrogate_key(COST_GRAIN, *key_format).alias("attribution_id"),
        *daily.columns,
        S.rate(F.col("oom_jobs"), F.col("total_jobs")).alias("oom_rate"),
        S.rate(F.col("succeeded_jobs"), ended).alias("success_rate"),
    )


def gpu_utilization_hourly(staged_metrics: DataFrame, method: Method = "exact", sketches: bool = False) -> DataFrame:
    """Hourly load, heat, power and capacity signals per GPU type and rack.

    ``sketches`` adds ``node_sketch`` and ``gpu_sketch``, from which ``reads.active_over_days`` counts
    over longer spans, where hourly counts can't be added up.
    """
    wanted = [Percentile("p50_gpu_util_pct", 0.50), Percentile("p95_gpu_util_pct", 0.95)]
    if method == "exact":
        percentiles = select_percentiles(staged_metrics, UTILIZATION_GRAIN, "gpu_util_pct", wanted)
    else:
        percentiles = staged_metrics.groupBy(*UTILIZATION_GRAIN).agg(*approx_percentile_columns("gpu_util_pct", wanted))
    hourly = zip_on_keys([_hourly_totals(staged_metrics, sketches), percentiles], UTILIZATION_GRAIN)

    def rounded(c: str, digits: int = 2) -> Column:
        return rnd(F.col(c), digits).alias(c)

    return hourly.select(
        "hour_bucket",
        "metric_date",
        F.hour("hour_bucket").alias("hour_of_day"),
        S.day_of_week(F.col("hour_bucket")).alias("day_of_week"),
        "gpu_type", "gpu_tier", "rack_id",
        rounded("avg_gpu_util_pct"), rounded("p50_gpu_util_pct"), rounded("p95_gpu_util_pct"),
        rounded("max_gpu_util_pct"),
        rounded("avg_memory_util_pct"), rounded("max_memory_util_pct"),
        rounded("avg_temp_celsius", 1), rounded("max_temp_celsius", 1),
        rnd(F.col("power_watts") / 1000.0, 2).alias("total_power_kw"),
        "active_nodes", "active_gpus", "high_util_gpu_count", "idle_gpu_count", "thermal_warning_count",
        S.rate(F.col("high_util_gpu_count"), F.col("active_gpus")).alias("high_util_rate"),
        S.rate(F.col("idle_gpu_count"), F.col("active_gpus")).alias("idle_rate"),
        *SKETCHES[:len(SKETCHES) if sketches else 0],
    )


def _hourly_totals(staged_metrics: DataFrame, sketches: bool) -> DataFrame:
    """Everything but the percentiles, reduced per GPU first.

    The distinct counts then run over one row per GPU and hour instead of expanding
    every reading, and a hot rack is spread over its GPUs.
    """
    util, memory, temp = F.col("gpu_util_pct"), F.col("memory_util_pct"), F.col("temp_celsius")
    per_gpu = staged_metrics.groupBy(*UTILIZATION_GRAIN, "node_id", "gpu_id").agg(
        S.exact_parts(util).alias("util_sum"), F.count(util).alias("util_n"), F.max(util).alias("util_max"),
        S.exact_parts(memory).alias("memory_sum"), F.count(memory).alias("memory_n"), F.max(memory).alias("memory_max"),
        S.exact_parts(temp).alias("temp_sum"), F.count(temp).alias("temp_n"), F.max(temp).alias("temp_max"),
        S.exact_parts(F.col("power_watts")).alias("power"),
        F.count_if(util > 90).alias("high"), F.count_if(util < 10).alias("idle"), F.count_if(temp > 85).alias("hot"),
    )

    def mean(name: str) -> Column:
        return S.parts_total(S.merged_parts(F.col(f"{name}_sum"))) / F.nullif(F.sum(f"{name}_n"), F.lit(0))

    return per_gpu.groupBy(*UTILIZATION_GRAIN).agg(
        mean("util").alias("avg_gpu_util_pct"), F.max("util_max").alias("max_gpu_util_pct"),
        mean("memory").alias("avg_memory_util_pct"), F.max("memory_max").alias("max_memory_util_pct"),
        mean("temp").alias("avg_temp_celsius"), F.max("temp_max").alias("max_temp_celsius"),
        S.parts_total(S.merged_parts(F.col("power"))).alias("power_watts"),
        F.count_distinct("node_id").alias("active_nodes"), F.count_distinct("gpu_id").alias("active_gpus"),
        F.sum("high").alias("high_util_gpu_count"), F.sum("idle").alias("idle_gpu_count"),
        F.sum("hot").alias("thermal_warning_count"),
        *(F.hll_sketch_agg(c, SKETCH_BITS).alias(s) for c, s in zip(("node_id", "gpu_id"), SKETCHES) if sketches),
    )


def job_performance_sla(staged_inference: DataFrame, method: Method = "exact") -> DataFrame:
    """Daily volume, latency distribution, tokens, cost and SLO verdict per model and region."""
    served = successful_requests(staged_inference)
    # One shared condition, so that both percentiles count as one measure.
    uncached = F.col("cache_hit") == F.lit(False)
    wanted = [
        Percentile("p50_latency_ms", 0.50),
        Percentile("p95_latency_ms", 0.95),
        Percentile("p99_latency_ms", 0.99),
        Percentile("p50_latency_ms_non_cached", 0.50, uncached),
        Percentile("p99_latency_ms_non_cached", 0.99, uncached),
    ]
    totals = [
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if("cache_hit").alias("cache_hit_requests"),
        S.exact_avg(F.col("latency_ms")).alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        (F.sum("total_tokens") / F.nullif(F.count("total_tokens"), F.lit(0))).alias("avg_tokens_per_request"),
        F.sum("total_tokens").alias("total_tokens"),
        S.exact_sum(F.col("cost_usd")).alias("total_cost_usd"),
        S.exact_avg(F.col("cost_usd")).alias("avg_cost_per_request"),
    ]
    if method == "exact":
        percentiles = select_percentiles(served, SLA_GRAIN, "latency_ms", wanted)
        daily = zip_on_keys([served.groupBy(*SLA_GRAIN).agg(*totals), percentiles], SLA_GRAIN)
    else:
        daily = served.groupBy(*SLA_GRAIN).agg(*totals, *approx_percentile_columns("latency_ms", wanted))

    def rounded(c: str, digits: int = 2) -> Column:
        return rnd(F.col(c), digits).alias(c)

    shaped = daily.select(
        *SLA_GRAIN,
        "total_requests", "cache_hit_requests",
        S.rate(F.col("cache_hit_requests"), F.col("total_requests")).alias("cache_hit_rate"),
        rounded("avg_latency_ms"),
        rounded("p50_latency_ms"), rounded("p95_latency_ms"), rounded("p99_latency_ms"), rounded("max_latency_ms"),
        rounded("p50_latency_ms_non_cached"), rounded("p99_latency_ms_non_cached"),
        rounded("avg_tokens_per_request", 0), "total_tokens", rounded("total_cost_usd", 4),
        rounded("avg_cost_per_request", 8),
    )
    # The verdict is taken on the rounded p99, the one readers see.
    return shaped.withColumns(
        {
            "slo_p99_breached": S.slo_breached(F.col("model_id"), F.col("p99_latency_ms")),
            "model_size_tier": S.model_size_tier(F.col("model_id")),
        }
    )


# ---------------------------------------------------------------- presentation order
# Each order ends in the rest of the grain: results are reproducible, and the range
# partitioning of the sort can cut through a crowded day or hour.


def order_cost_attribution(mart: DataFrame) -> DataFrame:
    return mart.orderBy(
        F.desc_nulls_last("job_date"), F.desc_nulls_last("total_cost_usd"), F.asc_nulls_last("attribution_id")
    )


def order_utilization(mart: DataFrame) -> DataFrame:
    return mart.orderBy(
        F.desc_nulls_last("hour_bucket"), F.asc_nulls_last("gpu_type"), F.asc_nulls_last("rack_id")
    )


def order_sla(mart: DataFrame) -> DataFrame:
    return mart.orderBy(
        F.desc_nulls_last("log_date"), F.desc_nulls_last("total_requests"),
        F.asc_nulls_last("model_id"), F.asc_nulls_last("region"),
    )
