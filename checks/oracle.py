"""The registered queries in DuckDB SQL, written independently of the Spark plans.

Each query is assembled from the common table expressions it needs.
"""

from __future__ import annotations

import re

from checks import fixtures as X

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF_DATE = "DATE '2024-02-01'"
COST_DATE = "DATE '2024-01-20'"

JOB_COLUMNS = [
    "job_id", "org_id", "user_id", "gpu_type", "gpu_count", "framework", "model_arch", "dataset_size_gb",
    "started_at", "ended_at", "duration_hours", "exit_code", "cost_usd", "is_late_arrival",
]
COMPLETION_COLUMNS = ["job_id", "ended_at", "duration_hours", "exit_code", "cost_usd", "late_delay_hours"]
REQUEST_COLUMNS = [
    "request_id", "org_id", "user_id", "model_id", "region", "status_code", "cache_hit", "input_tokens",
    "output_tokens", "total_tokens", "latency_ms", "cost_usd", "timestamp",
]
METRIC_COLUMNS = [
    "timestamp", "node_id", "gpu_id", "gpu_index", "gpu_type", "rack_id", "gpu_util_pct", "memory_util_pct",
    "temp_celsius", "power_watts",
]
COST_KEY = ["job_date", "org_id", "user_id", "model_arch", "gpu_tier", "gpu_type", "framework"]


def _first_of(table: str, columns: list[str], keys: list[str], prefer: str = "") -> str:
    rank = prefer + ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)
    return f"""
    SELECT {', '.join(columns)} FROM {table}
    QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {rank}) = 1"""


def _tier(c: str) -> str:
    return f"CASE left({c}, 4) WHEN 'H100' THEN 'flagship' WHEN 'A100' THEN 'performance' ELSE 'standard' END"


def _price(c: str) -> str:
    return f"""CASE {c} WHEN 'H100-SXM5-80GB' THEN 4.25::DOUBLE WHEN 'A100-SXM4-80GB' THEN 3.0::DOUBLE
      WHEN 'A100-PCIe-40GB' THEN 2.21::DOUBLE WHEN 'RTX-4090' THEN 0.74::DOUBLE WHEN 'A10G' THEN 0.9::DOUBLE END"""


def _size(c: str) -> str:
    return f"""CASE WHEN contains({c}, '405b') THEN 'xl' WHEN contains({c}, '70b') THEN 'large'
      WHEN regexp_matches({c}, '34b|mixtral') THEN 'medium' ELSE 'small' END"""


def _breach(model: str, p99: str) -> str:
    return f"""{p99} > CASE WHEN contains({model}, '405b') THEN 8000 WHEN contains({model}, '70b') THEN 5000
      ELSE 2000 END"""


def _key(columns: list[str], sep: str, null: str) -> str:
    return f"md5({f' || {sep!r} || '.join(f'coalesce(({c})::VARCHAR, {null!r})' for c in columns)})"


def _tally(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)::BIGINT"


def _sum(value: str) -> str:
    """The double nearest to the total of whole multiples of 2**-62; NaN and infinities as in a plain sum."""
    whole = f"sum(CASE WHEN isfinite({value}) THEN (({value}) * {2**62}::DOUBLE)::HUGEINT END)"
    nearest = f"((({whole}) // {2**40})::DOUBLE * {2**40}::DOUBLE + (({whole}) % {2**40})::DOUBLE) / {2**62}::DOUBLE"
    return f"CASE WHEN bool_and(isfinite({value})) THEN {nearest} ELSE sum({value}) END"


def _avg(value: str) -> str:
    return f"(({_sum(value)}) / nullif(count({value}), 0))"


CTES: dict[str, str] = {
    "jobs_start": X.jobs_start(X.DUCKDB),
    "job_lines": X.job_lines(X.DUCKDB),
    "jobs_completion": X.jobs_completion(X.DUCKDB),
    "inference": X.inference(X.DUCKDB),
    "node_metrics": X.node_metrics(X.DUCKDB),
    "jobs_bronze": X.jobs_bronze(),
    "completions_bronze": X.completions_bronze(),
    "inference_bronze": X.inference_bronze(),
    "envelope": X.envelope(X.DUCKDB, "NULL"),
    "jobs_once": _first_of("jobs_bronze", JOB_COLUMNS, ["job_id"], "ended_at DESC NULLS LAST, "),
    "completions": _first_of("completions_bronze", COMPLETION_COLUMNS, ["job_id"], "ended_at DESC NULLS LAST, "),
    "inference_once": _first_of("inference_bronze", REQUEST_COLUMNS, ["request_id"]),
    "metrics_once": _first_of("node_metrics", METRIC_COLUMNS, ["gpu_id", "timestamp"]),
    "silver_jobs": f"""
    SELECT * REPLACE (is_late_arrival = 'true' AS is_late_arrival),
      {_price('gpu_type')} AS price_per_gpu_hour, exit_code = 0 AS is_success,
      duration_hours * gpu_count AS gpu_hours, started_at::DATE AS job_date
    FROM jobs_once""",
    "silver_inference": """
    SELECT * REPLACE (cache_hit = 'true' AS cache_hit), status_code = 200 AS is_success,
      timestamp::DATE AS log_date, hour(timestamp)::INTEGER AS log_hour
    FROM inference_once""",
    "silver_node_metrics": "SELECT *, timestamp::DATE AS metric_date FROM metrics_once",
    "merged_jobs": """
    SELECT j.* REPLACE (
      CASE WHEN c.job_id IS NULL THEN j.ended_at ELSE c.ended_at END AS ended_at,
      CASE WHEN c.job_id IS NULL THEN j.duration_hours ELSE c.duration_hours END AS duration_hours,
      CASE WHEN c.job_id IS NULL THEN j.exit_code ELSE c.exit_code END AS exit_code,
      CASE WHEN c.job_id IS NULL THEN j.cost_usd ELSE c.cost_usd END AS cost_usd,
      CASE WHEN c.job_id IS NULL THEN j.gpu_hours ELSE c.duration_hours * j.gpu_count END AS gpu_hours,
      CASE WHEN c.job_id IS NULL THEN j.is_success ELSE c.exit_code = 0 END AS is_success)
    FROM silver_jobs j LEFT JOIN completions c ON c.job_id = j.job_id AND j.ended_at IS NULL""",
    "stg_jobs": "SELECT * FROM merged_jobs WHERE started_at IS NOT NULL",
    "stg_inference": """
    SELECT * EXCLUDE (timestamp), timestamp AS requested_at FROM silver_inference WHERE timestamp IS NOT NULL""",
    "stg_node_metrics": f"""
    SELECT timestamp AS metric_ts, time_bucket(INTERVAL 1 HOUR, timestamp) AS hour_bucket,
      timestamp::DATE AS metric_date, node_id, gpu_id, rack_id, gpu_type, {_tier('gpu_type')} AS gpu_tier,
      gpu_util_pct, memory_util_pct, temp_celsius, power_watts
    FROM silver_node_metrics WHERE timestamp IS NOT NULL""",
    "billed": f"""
    SELECT *, CASE WHEN coalesce(exit_code, 0) = 143 THEN 0.0::DOUBLE WHEN ended_at IS NULL
        THEN (epoch_us({AS_OF}) - epoch_us(started_at)) / 1e6::DOUBLE / 3600::DOUBLE
        ELSE duration_hours END AS billable_hours
    FROM stg_jobs""",
    "int_job_costs": f"""
    SELECT job_id, org_id, user_id, gpu_type, gpu_count, framework, model_arch, dataset_size_gb, started_at,
      ended_at, exit_code, is_success, is_late_arrival, job_date, billable_hours, gpu_hours, price_per_gpu_hour,
      if(coalesce(exit_code, 0) = 143, 0.0::DOUBLE, round(billable_hours * gpu_count * price_per_gpu_hour, 6))
        AS cost_usd,
      CASE WHEN ended_at IS NULL THEN 'running' WHEN exit_code IN (0, 137, 143)
        THEN map {{0: 'succeeded', 137: 'oom_killed', 143: 'platform_error'}}[exit_code] ELSE 'failed' END
        AS job_status,
      {_tier('gpu_type')} AS gpu_tier
    FROM billed""",
    "cost_totals": f"""
    SELECT {', '.join(COST_KEY)}, count(*) AS total_jobs,
      {_tally("job_status = 'succeeded'")} AS succeeded_jobs, {_tally("job_status = 'oom_killed'")} AS oom_jobs,
      {_tally("job_status = 'failed'")} AS failed_jobs, {_tally("job_status = 'running'")} AS running_jobs,
      round({_sum('cost_usd')}, 4) AS total_cost_usd, round({_sum('gpu_hours')}, 4) AS total_gpu_hours,
      round({_avg("CASE WHEN job_status = 'succeeded' THEN cost_usd END")}, 4) AS avg_cost_per_success_usd,
      round({_avg("CASE WHEN job_status = 'succeeded' THEN billable_hours END")}, 4) AS avg_duration_hours,
      round(max(billable_hours), 4) AS max_duration_hours
    FROM int_job_costs WHERE job_date IS NOT NULL GROUP BY ALL""",
    "cost_attribution": f"""
    SELECT {_key(COST_KEY, '-', '_dbt_utils_surrogate_key_null_')} AS attribution_id, *,
      round(oom_jobs::DOUBLE / total_jobs, 4) AS oom_rate,
      CASE WHEN total_jobs > running_jobs
        THEN round(succeeded_jobs::DOUBLE / (total_jobs - running_jobs), 4) END AS success_rate
    FROM cost_totals""",
    "hour_totals": f"""
    SELECT hour_bucket, metric_date, gpu_type, gpu_tier, rack_id,
      round({_avg('gpu_util_pct')}, 2) AS avg_gpu_util_pct,
      round(quantile_cont(gpu_util_pct, 0.5), 2) AS p50_gpu_util_pct,
      round(quantile_cont(gpu_util_pct, 0.95), 2) AS p95_gpu_util_pct,
      round(max(gpu_util_pct), 2) AS max_gpu_util_pct,
      round({_avg('memory_util_pct')}, 2) AS avg_memory_util_pct, round(max(memory_util_pct), 2) AS max_memory_util_pct,
      round({_avg('temp_celsius')}, 1) AS avg_temp_celsius, round(max(temp_celsius), 1) AS max_temp_celsius,
      round({_sum('power_watts')} / 1000, 2) AS total_power_kw,
      count(DISTINCT node_id) AS active_nodes, count(DISTINCT gpu_id) AS active_gpus,
      {_tally('gpu_util_pct > 90')} AS high_util_gpu_count, {_tally('gpu_util_pct < 10')} AS idle_gpu_count,
      {_tally('temp_celsius > 85')} AS thermal_warning_count
    FROM stg_node_metrics GROUP BY ALL""",
    "gpu_utilization_hourly": """
    SELECT *, hour(hour_bucket)::INTEGER AS hour_of_day, dayofweek(hour_bucket)::INTEGER AS day_of_week,
      round(high_util_gpu_count::DOUBLE / active_gpus, 4) AS high_util_rate,
      round(idle_gpu_count::DOUBLE / active_gpus, 4) AS idle_rate
    FROM hour_totals""",
    "day_totals": f"""
    SELECT log_date, model_id, region, count(*) AS total_requests, {_tally('cache_hit')} AS cache_hit_requests,
      round({_avg('latency_ms')}, 2) AS avg_latency_ms, round(max(latency_ms), 2) AS max_latency_ms,
      round(quantile_cont(latency_ms, 0.5), 2) AS p50_latency_ms,
      round(quantile_cont(latency_ms, 0.95), 2) AS p95_latency_ms,
      round(quantile_cont(latency_ms, 0.99), 2) AS p99_latency_ms,
      round(quantile_cont(CASE WHEN NOT cache_hit THEN latency_ms END, 0.5), 2) AS p50_latency_ms_non_cached,
      round(quantile_cont(CASE WHEN NOT cache_hit THEN latency_ms END, 0.99), 2) AS p99_latency_ms_non_cached,
      round({_avg('total_tokens')}, 0) AS avg_tokens_per_request, sum(total_tokens)::BIGINT AS total_tokens,
      round({_sum('cost_usd')}, 4) AS total_cost_usd, round({_avg('cost_usd')}, 8) AS avg_cost_per_request
    FROM stg_inference WHERE is_success GROUP BY ALL""",
    "job_performance_sla": f"""
    SELECT *, round(cache_hit_requests::DOUBLE / total_requests, 4) AS cache_hit_rate,
      {_breach('model_id', 'p99_latency_ms')} AS slo_p99_breached, {_size('model_id')} AS model_size_tier
    FROM day_totals""",
    # gate: (label, failing rows) per check are written out below
    "jobs_figures": """
    SELECT count(*) AS n, count(job_id) AS n_job, count(gpu_count) AS n_gpus, count(cost_usd) AS n_cost,
      count(gpu_type) AS n_type, count(framework) AS n_fw, avg(cost_usd) AS mean_cost,
      quantile_cont(gpu_count, 0.5) AS median_gpus,
      count(*) - count(org_id) AS no_org, count(*) - count(user_id) AS no_user,
      count(*) - count(started_at) AS no_start,
      sum((gpu_count < 1 OR gpu_count > 512)::INT) AS bad_gpus, sum((cost_usd < 0)::INT) AS bad_cost,
      sum((gpu_type NOT IN ('H100-SXM5-80GB', 'A100-SXM4-80GB', 'A100-PCIe-40GB', 'RTX-4090', 'A10G'))::INT)
        AS bad_type,
      sum((framework NOT IN ('pytorch', 'jax', 'tensorflow', 'deepspeed'))::INT) AS bad_fw
    FROM silver_jobs""",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Names of the table expressions used, dependencies first."""
    for name in CTES:
        if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def _query(sql: str) -> str:
    names = _needed(sql, [])
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {head}\n{sql}" if names else sql


def _checks(rows: list[tuple], table: str) -> str:
    """Expectation results: (kind, column, considered, failing, observed, success) as SQL."""
    parts = []
    for i, (kind, column, considered, failing, observed, success) in enumerate(rows, 1):
        name = f"'{column}'" if column else "NULL::VARCHAR"
        parts.append(
            f"SELECT {i} AS check_no, '{kind}' AS expectation, {name} AS column_name, "
            f"({considered})::BIGINT AS considered, ({failing})::BIGINT AS failing, "
            f"({observed})::DOUBLE AS observed, ({success}) AS success FROM {table}"
        )
    union = "\nUNION ALL\n".join(parts)
    return f"SELECT *, bool_and(success) OVER () AS gate_passed FROM ({union})"


def _share(considered: str, failing: str) -> str:
    return f"({considered} - {failing})::DOUBLE / {considered}"


def _value_check(kind: str, column: str, considered: str, failing: str, mostly: float = 1.0) -> tuple:
    share = _share(considered, failing)
    return kind, column, considered, failing, share, f"{share} >= {mostly}"


def _failures(rows: list[tuple[str, str, str, str]]) -> str:
    """Column test results: (table, column, test, scalar query)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS test, ({q})::BIGINT AS failures"
        for t, c, k, q in rows
    )


def _repeats(table: str, column: str) -> str:
    return f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY 1 HAVING count({column}) > 1)"


def _count_where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _upserted(table: str, key: list[str], ts: str, old_until: str, new_from: str, merged: dict[str, str],
              delivered: dict[str, str], columns: list[str]) -> str:
    """Stored rows with the delivered values of ``merged``, then deliveries without a stored row."""
    on = " AND ".join(f"n.{k} = o.{k}" for k in key)
    kept = ", ".join(
        f"CASE WHEN n.{key[0]} IS NULL THEN o.{c} ELSE n.{c} END AS {c}" if c in merged else f"o.{c} AS {c}"
        for c in columns
    )
    replaced = ", ".join(f"{e} AS {c}" for c, e in delivered.items())
    return f"""
    , stored_part AS (SELECT * FROM {table} WHERE {ts} < TIMESTAMP '{old_until}'),
    delivery AS (SELECT * REPLACE ({replaced}) FROM {table} WHERE {ts} >= TIMESTAMP '{new_from}')
    SELECT {kept} FROM stored_part o LEFT JOIN delivery n ON {on}
    UNION ALL BY NAME
    SELECT {', '.join(columns)} FROM delivery n ANTI JOIN stored_part o ON {on}"""


def _with_upsert(table: str, **kw) -> str:
    """Upsert queries bring their own table expressions after the shared ones."""
    tail = _upserted(table, **kw)
    names = _needed(f"FROM {table}", [])
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + tail


SILVER_JOB_COLUMNS = [*JOB_COLUMNS, "price_per_gpu_hour", "is_success", "gpu_hours", "job_date"]


def _upsert_jobs() -> str:
    updated = ["ended_at", "duration_hours", "exit_code", "cost_usd", "gpu_hours", "is_success"]
    return _with_upsert(
        "merged_jobs", key=["job_id"], ts="started_at", old_until="2024-01-22 00:00:00",
        new_from="2024-01-20 00:00:00", merged=dict.fromkeys(updated, ""),
        delivered={"cost_usd": "cost_usd + 1", "exit_code": "NULL::INTEGER", "org_id": "'org-new'"},
        columns=SILVER_JOB_COLUMNS,
    )


RECENT_COST = f"FROM cost_attribution WHERE job_date >= {AS_OF_DATE} - 7"
RECENT_SLA = f"FROM job_performance_sla WHERE log_date >= {AS_OF_DATE} - 7"
COST_FIGURES = f"""round({_sum('total_cost_usd')}, 2) AS total_usd, round({_sum('total_gpu_hours')}, 1) AS total_gpu_hours,
      sum(total_jobs)::BIGINT AS total_jobs, round({_avg('success_rate')}, 4) AS avg_success_rate,
      round({_avg('oom_rate')}, 4) AS avg_oom_rate"""
SLO_FIGURES = """count(CASE WHEN slo_p99_breached THEN 1 END) AS breach_count, count(*) AS total_model_days,
      round(1 - count(CASE WHEN slo_p99_breached THEN 1 END)::DOUBLE / greatest(count(*), 1), 4) AS compliance_rate"""
SLA_DAY = f"""
    SELECT model_id, region, model_size_tier, total_requests, cache_hit_rate, round(p50_latency_ms, 1) AS p50_ms,
      round(p95_latency_ms, 1) AS p95_ms, round(p99_latency_ms, 1) AS p99_ms,
      round(p99_latency_ms_non_cached, 1) AS p99_ms_non_cached, slo_p99_breached, total_cost_usd
    FROM job_performance_sla WHERE log_date = {COST_DATE}"""
STREAM_ROWS = """
    SELECT e.offset AS kafka_offset, e.partition AS kafka_partition, e.timestamp AS kafka_timestamp,
      i.* REPLACE (i.cache_hit = 'true' AS cache_hit)"""
STREAM_JOIN = "FROM envelope e JOIN inference i ON i.request_id = e.key"
HOURS = "hour_bucket, gpu_type, rack_id, hour_of_day, day_of_week, high_util_rate, idle_rate"


def _sources() -> dict[str, str]:
    return {
        "read_job_events": "SELECT * FROM jobs_bronze",
        "read_job_completions": "SELECT * FROM completions_bronze",
        "read_inference_logs": "SELECT * FROM inference_bronze",
        "read_node_metrics": "SELECT * FROM node_metrics",
        "read_malformed": """
    SELECT job_id, CASE WHEN gpu_count < 16 THEN gpu_count END AS gpu_count, NULL::VARCHAR AS text, NULL::BOOLEAN AS kept
    FROM job_lines WHERE gpu_count NOT IN (16, 64)
    UNION ALL SELECT NULL, NULL, line, gpu_count = 32 FROM job_lines WHERE gpu_count >= 16""",
        "scan_table": "SELECT * FROM events",
        "kafka_stream_source": "SELECT \"offset\", partition, timestamp, key FROM envelope",
        "write_partitioned_overwrite": "SELECT * FROM silver_jobs",
        "stream_append_sink": f"{STREAM_ROWS}, i.timestamp::DATE AS log_date, hour(i.timestamp)::INTEGER AS log_hour "
                              f"{STREAM_JOIN}",
        "to_kafka_records": "SELECT job_id AS key, job_id, gpu_count, started_at, ended_at, duration_hours, cost_usd, "
                            "is_late_arrival FROM jobs_start",
        "dedup_jobs": "SELECT * FROM jobs_once",
        "dedup_completions": "SELECT * FROM completions",
        "dedup_inference": "SELECT * FROM inference_once",
        "dedup_node_metrics": "SELECT * FROM metrics_once",
    }


def _projections() -> dict[str, str]:
    hour = "time_bucket(INTERVAL 1 HOUR, started_at)"
    keyed = ["job_id", "exit_code", "job_date", hour]
    return {
        "price_lookup": f"SELECT job_id, {_price('gpu_type')} AS price_per_gpu_hour, NULL::DOUBLE AS unknown_price "
                        "FROM jobs_start",
        "string_to_boolean": "SELECT request_id, cache_hit = 'true' AS cache_hit, NULL::BOOLEAN AS junk FROM inference",
        "job_success_flag": "SELECT job_id, exit_code, exit_code = 0 AS is_success FROM jobs_start",
        "request_success_flag": "SELECT request_id, status_code = 200 AS is_success FROM inference",
        "gpu_hours": "SELECT job_id, duration_hours * gpu_count AS gpu_hours FROM jobs_start",
        "date_hour_parts": "SELECT request_id, timestamp, timestamp::DATE AS log_date, "
                           "hour(timestamp)::INTEGER AS log_hour FROM inference",
        "ingest_stamp": f"SELECT job_id, {AS_OF} AS _ingested_at FROM jobs_start",
        "silver_jobs": "SELECT * FROM silver_jobs",
        "silver_inference": "SELECT * FROM silver_inference",
        "silver_node_metrics": "SELECT * FROM silver_node_metrics",
        "stg_jobs": "SELECT * FROM stg_jobs",
        "stg_inference": "SELECT * FROM stg_inference",
        "stg_node_metrics": "SELECT * FROM stg_node_metrics",
        "billable_hours": "SELECT job_id, billable_hours FROM int_job_costs",
        "job_cost": "SELECT job_id, cost_usd FROM int_job_costs",
        "job_status": "SELECT job_id, job_status FROM int_job_costs",
        "gpu_tier": f"SELECT gpu_type, {_tier('gpu_type')} AS gpu_tier FROM node_metrics",
        "int_job_costs": "SELECT * FROM int_job_costs",
        "slo_breach_flag": f"SELECT request_id, {_breach('model_id', 'latency_ms')} AS breached FROM inference",
        "model_size_tier": f"SELECT request_id, {_size('model_id')} AS model_size_tier FROM inference",
        "surrogate_key": f"SELECT job_id, {_key(keyed, '||', '_null_')} AS local_key, "
                         f"{_key(keyed, '-', '_dbt_utils_surrogate_key_null_')} AS package_key FROM stg_jobs",
        "utilization_rates": f"SELECT {HOURS} FROM gpu_utilization_hourly",
        "capacity_pressure": """
    SELECT gpu_util_pct, CASE WHEN gpu_util_pct <= 65 THEN 'low' WHEN gpu_util_pct <= 85 THEN 'medium' ELSE 'high' END
        AS pressure,
      CASE WHEN gpu_util_pct = 2 THEN NULL WHEN gpu_util_pct <= 65 THEN 'low' WHEN gpu_util_pct <= 85 THEN 'medium'
        ELSE 'high' END AS pressure_or_null
    FROM node_metrics""",
        "compliance_rate": """
    SELECT *, round(1 - breaches::DOUBLE / days, 4) AS compliance_rate FROM (
      SELECT model_id, count(CASE WHEN slo_p99_breached THEN 1 END) AS breaches, count(*) AS days
      FROM job_performance_sla GROUP BY model_id)""",
        "filter_gold_jobs": "SELECT job_id, job_date FROM silver_jobs WHERE exit_code <> 1",
        "filter_successful_requests": "SELECT request_id, is_success FROM stg_inference WHERE status_code = 200",
        "date_range_filter": f"SELECT job_id, job_date FROM silver_jobs WHERE job_date > {COST_DATE} - 3 "
                             f"AND job_date <= {COST_DATE}",
        "rolling_days_filter": f"SELECT job_id, job_date FROM silver_jobs WHERE job_date > {AS_OF_DATE} - 8",
        "optional_equality_filters": "SELECT request_id, region, model_id FROM inference "
                                     "WHERE model_id = 'llama-3-70b-instruct' AND region = 'us-east-1'",
    }


def _merges() -> dict[str, str]:
    return {
        "merge_completions": "SELECT * FROM merged_jobs",
        "late_fill_left_join": """
    SELECT j.job_id, if(j.ended_at IS NULL, c.ended_at, j.ended_at) AS ended_at,
      if(j.ended_at IS NULL, c.cost_usd, j.cost_usd) AS cost_usd,
      if(j.ended_at IS NULL, coalesce(c.exit_code, j.exit_code), j.exit_code) AS exit_code
    FROM jobs_once j LEFT JOIN completions c USING (job_id)""",
    }


def _upserts() -> dict[str, str]:
    return {
        "upsert_merge": _upsert_jobs(),
        "upsert_jobs": _upsert_jobs(),
        "upsert_key_filters": _upsert_jobs(),
        "upsert_inference": _with_upsert(
            "silver_inference", key=["request_id"], ts="timestamp", old_until="2024-01-20 00:00:00",
            new_from="2024-01-15 00:00:00", merged=dict.fromkeys(["status_code", "latency_ms", "cost_usd"], ""),
            delivered={"latency_ms": "latency_ms + 1", "region": "'new'"},
            columns=[*REQUEST_COLUMNS, "is_success", "log_date", "log_hour"],
        ),
        "upsert_node_metrics": _with_upsert(
            "silver_node_metrics", key=["gpu_id", "timestamp"], ts="timestamp", old_until="2024-01-03 00:00:00",
            new_from="2024-01-02 00:00:00",
            merged=dict.fromkeys(["gpu_util_pct", "memory_util_pct", "temp_celsius", "power_watts"], ""),
            delivered={"gpu_util_pct": "gpu_util_pct / 2", "rack_id": "'new'"},
            columns=[*METRIC_COLUMNS, "metric_date"],
        ),
    }


def _aggregates() -> dict[str, str]:
    return {
        "cost_attribution": "SELECT * FROM cost_attribution",
        "gpu_utilization_hourly": "SELECT * FROM gpu_utilization_hourly",
        "job_performance_sla": "SELECT * FROM job_performance_sla",
        "cost_by_org": f"""
    SELECT org_id, round({_sum('total_cost_usd')}, 4) AS total_cost_usd, round({_sum('total_gpu_hours')}, 2) AS total_gpu_hours,
      sum(total_jobs)::BIGINT AS total_jobs, sum(succeeded_jobs)::BIGINT AS succeeded_jobs,
      sum(oom_jobs)::BIGINT AS oom_jobs, round({_avg('oom_rate')}, 4) AS avg_oom_rate,
      round({_avg('success_rate')}, 4) AS avg_success_rate
    FROM cost_attribution WHERE job_date > {COST_DATE} - 3 AND job_date <= {COST_DATE} GROUP BY org_id""",
        "cost_by_model": f"""
    SELECT model_arch, gpu_tier, round({_sum('total_cost_usd')}, 4) AS total_cost_usd,
      round({_sum('total_gpu_hours')}, 2) AS total_gpu_hours, sum(total_jobs)::BIGINT AS total_jobs,
      round({_avg('avg_cost_per_success_usd')}, 4) AS avg_cost_per_job,
      round({_avg('avg_duration_hours')}, 4) AS avg_duration_hours
    FROM cost_attribution WHERE job_date > {COST_DATE} - 7 AND job_date <= {COST_DATE} GROUP BY ALL""",
        "capacity_summary": f"""
    SELECT *, CASE WHEN avg_util_pct <= 65 THEN 'low' WHEN avg_util_pct <= 85 THEN 'medium' ELSE 'high' END
        AS capacity_pressure
    FROM (SELECT gpu_type, gpu_tier, round({_avg('avg_gpu_util_pct')}, 2) AS avg_util_pct,
        round(max(p95_gpu_util_pct), 2) AS peak_p95_util_pct, round({_avg('idle_rate')}, 4) AS avg_idle_rate,
        round({_avg('high_util_rate')}, 4) AS avg_high_util_rate,
        sum(thermal_warning_count)::BIGINT AS total_thermal_warnings
      FROM gpu_utilization_hourly WHERE metric_date >= DATE '2024-01-05' - 7 GROUP BY ALL)""",
        "active_over_days": """
    SELECT gpu_type, gpu_tier, count(DISTINCT node_id) AS active_nodes, count(DISTINCT gpu_id) AS active_gpus
    FROM stg_node_metrics WHERE metric_date >= DATE '2024-01-05' - 7 GROUP BY ALL""",
        "stream_progress": """
    SELECT partition AS kafka_partition, max("offset") AS kafka_offset, max(timestamp) AS _stream_ingested_at
    FROM envelope GROUP BY ALL""",
        "dashboard_cost_summary": f"SELECT {COST_FIGURES} {RECENT_COST}",
        "dashboard_slo_summary": f"SELECT {SLO_FIGURES} {RECENT_SLA}",
        "dashboard_summary": f"SELECT 'last_7_days' AS period, c.*, s.* FROM (SELECT {COST_FIGURES} {RECENT_COST}) c, "
                             f"(SELECT {SLO_FIGURES} {RECENT_SLA}) s",
        "stream_freshness": """
    SELECT *, lag_minutes > 10 AS is_stale FROM (
      SELECT max(timestamp) AS latest,
        (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(timestamp))) / 6e7::DOUBLE AS lag_minutes
      FROM envelope)""",
        "consumer_lag": f"""
    SELECT count(*) AS partitions, sum(newest - coalesce(done, 0))::BIGINT AS total_lag,
      sum(newest - coalesce(done, 0)) > 3000 AS is_lagging
    FROM (SELECT e.partition, max(e."offset") + 1 AS newest,
        max(CASE WHEN i.timestamp::DATE < {COST_DATE} THEN e."offset" END) + 1 AS done
      {STREAM_JOIN} GROUP BY e.partition)""",
        "order_cost_attribution": "SELECT * FROM cost_attribution",
        "order_utilization": "SELECT * FROM gpu_utilization_hourly",
        "order_sla": "SELECT * FROM job_performance_sla",
        "top_slo_breaches": f"""
    SELECT model_id, region, model_size_tier, p99_latency_ms, log_date FROM job_performance_sla
    WHERE slo_p99_breached AND log_date = {COST_DATE} ORDER BY p99_latency_ms DESC, model_id, region LIMIT 10""",
        "union_all": "SELECT job_id, count(*) AS copies FROM (FROM jobs_start UNION ALL FROM jobs_start) GROUP BY job_id",
        "distinct_keys": "SELECT DISTINCT job_id FROM jobs_bronze",
    }


def _reads() -> dict[str, str]:
    return {
        "utilization_hourly": """
    SELECT hour_bucket, hour_of_day, gpu_type, gpu_tier, avg_gpu_util_pct AS avg_util_pct,
      p95_gpu_util_pct AS p95_util_pct, active_gpus, high_util_gpu_count, idle_gpu_count, total_power_kw,
      thermal_warning_count
    FROM gpu_utilization_hourly WHERE metric_date = DATE '2024-01-02' AND gpu_type = 'A100-SXM4-80GB'""",
        "sla_by_model": SLA_DAY,
        "sla_by_model_breaches": f"{SLA_DAY} AND slo_p99_breached",
        "sla_trends": f"""
    SELECT log_date, region, total_requests, round(p50_latency_ms, 1) AS p50_ms, round(p99_latency_ms, 1) AS p99_ms,
      cache_hit_rate, slo_p99_breached
    FROM job_performance_sla
    WHERE log_date >= {AS_OF_DATE} - 14 AND region = 'eu-west-1' AND model_id = 'llama-3-70b-instruct'""",
        "parse_stream_payload": f"{STREAM_ROWS} {STREAM_JOIN}",
        "event_time_watermark": f"SELECT i.request_id, i.timestamp, e.partition AS kafka_partition {STREAM_JOIN}",
        "stream_date_hour_stamp": "SELECT request_id, timestamp::DATE AS log_date, "
                                  "hour(timestamp)::INTEGER AS log_hour FROM inference",
        "inference_stream_ingest": f"{STREAM_ROWS}, i.timestamp::DATE AS log_date, "
                                   f"hour(i.timestamp)::INTEGER AS log_hour {STREAM_JOIN}",
        "unique_requests": f"SELECT * EXCLUDE (kafka_offset) FROM ({STREAM_ROWS}, i.timestamp::DATE AS log_date, "
                           f"hour(i.timestamp)::INTEGER AS log_hour {STREAM_JOIN})",
        **dict.fromkeys(
            ["rate_limited_micro_batch", "restart_exactly_once"],
            f"{STREAM_ROWS}, i.timestamp::DATE AS log_date, hour(i.timestamp)::INTEGER AS log_hour {STREAM_JOIN}",
        ),
    }


# Known categories.
KNOWN_GPUS = "'H100-SXM5-80GB', 'A100-SXM4-80GB', 'A100-PCIe-40GB', 'RTX-4090', 'A10G'"
REPEATED_JOBS = "(SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM silver_jobs GROUP BY job_id HAVING count(job_id) > 1))"


def _quality() -> dict[str, str]:
    gate = _checks(
        [
            ("row_count_between", None, "n", "NULL", "n", "n >= 500"),
            _value_check("not_null", "job_id", "n", "(n - n_job)"),
            _value_check("not_null", "org_id", "n", "no_org"),
            _value_check("not_null", "user_id", "n", "no_user"),
            _value_check("not_null", "gpu_type", "n", "(n - n_type)"),
            _value_check("not_null", "gpu_count", "n", "(n - n_gpus)"),
            _value_check("not_null", "started_at", "n", "no_start"),
            _value_check("unique", "job_id", "n_job", REPEATED_JOBS),
            _value_check("between", "gpu_count", "n_gpus", "bad_gpus"),
            _value_check("between", "cost_usd", "n_cost", "bad_cost", 0.99),
            _value_check("in_set", "gpu_type", "n_type", "bad_type", 0.99),
            _value_check("in_set", "framework", "n_fw", "bad_fw", 0.98),
            ("mean_between", "cost_usd", "n_cost", "NULL", "mean_cost", "mean_cost BETWEEN 1 AND 500"),
            ("median_between", "gpu_count", "n_gpus", "NULL", "median_gpus", "median_gpus BETWEEN 1 AND 8"),
        ],
        "jobs_figures",
    )
    open_jobs = "(n - n_end)"
    jobs = "(SELECT count(*) AS n, count(job_id) AS n_id, count(ended_at) AS n_end FROM merged_jobs)"
    ranged = "(SELECT count(*) AS n, count(cost_usd) AS n_cost, sum((cost_usd < 10)::INT) AS low, " \
             "sum((gpu_count NOT BETWEEN 1 AND 512)::INT) AS odd FROM merged_jobs)"
    sets = "(SELECT count(*) AS n, sum((framework NOT IN ('pytorch', 'jax'))::INT) AS other, " \
           f"sum((gpu_type NOT IN ({KNOWN_GPUS}))::INT) AS unknown FROM merged_jobs)"
    repeated = "(SELECT sum(c) AS n, sum(CASE WHEN c > 1 THEN c ELSE 0 END) AS twice FROM " \
               "(SELECT count(*) AS c FROM jobs_bronze GROUP BY job_id))"
    centre = "(SELECT count(*) AS n, count(duration_hours) AS n_h, avg(gpu_count) AS mean_g, " \
             "median(gpu_count) AS med_g, median(duration_hours) AS med_h FROM silver_jobs)"
    rates = [("cost_attribution", c, "expression", _count_where("cost_attribution", f"NOT ({c} BETWEEN 0 AND 1)"))
             for c in ("oom_rate", "success_rate")]
    return {
        "expect_row_count_between": _checks(
            [("row_count_between", None, "n", "NULL", "n", "n >= 500"),
             ("row_count_between", None, "n", "NULL", "n", "n <= 10")], jobs),
        "expect_not_null": _checks(
            [_value_check("not_null", "job_id", "n", "(n - n_id)"), _value_check("not_null", "ended_at", "n", open_jobs),
             _value_check("not_null", "ended_at", "n", open_jobs, 0.9)], jobs),
        "expect_unique": _checks(
            [_value_check("unique", "job_id", "n", "twice"), _value_check("unique", "job_id", "n", "twice", 0.5)],
            repeated),
        "expect_between": _checks(
            [_value_check("between", "gpu_count", "n", "odd"), _value_check("between", "cost_usd", "n_cost", "low", 0.99)],
            ranged),
        "expect_in_set": _checks(
            [_value_check("in_set", "gpu_type", "n", "unknown", 0.99), _value_check("in_set", "framework", "n", "other", 0.98)],
            sets),
        "expect_mean_between": _checks(
            [("mean_between", "gpu_count", "n", "NULL", "mean_g", "mean_g BETWEEN 1 AND 500")], centre),
        "expect_median_between": _checks(
            [("median_between", "gpu_count", "n", "NULL", "med_g", "med_g BETWEEN 1 AND 8"),
             ("median_between", "duration_hours", "n_h", "NULL", "med_h", "med_h >= 5")], centre),
        "silver_jobs_gate": f"SELECT * REPLACE (round(observed, 6) AS observed) FROM ({gate})",
        "test_unique": _failures([
            ("jobs", "job_id", "unique", _repeats("jobs_bronze", "job_id")),
            ("inference", "request_id", "unique", _repeats("inference_bronze", "request_id")),
            ("cost_attribution", "attribution_id", "unique", _repeats("cost_attribution", "attribution_id")),
        ]),
        "test_not_null": _failures(
            [("jobs", c, "not_null", _count_where("jobs_bronze", f"{c} IS NULL"))
             for c in ("job_id", "org_id", "gpu_count", "started_at", "ended_at")]
            + [("inference", c, "not_null", _count_where("inference_bronze", f"{c} IS NULL"))
               for c in ("request_id", "model_id")]
            + [("cost_attribution", c, "not_null", _count_where("cost_attribution", f"{c} IS NULL"))
               for c in ("attribution_id", "total_cost_usd")]
            + [("job_performance_sla", "p99_latency_ms", "not_null",
                _count_where("job_performance_sla", "p99_latency_ms IS NULL"))]
        ),
        "test_accepted_values": _failures([
            ("jobs", "gpu_type", "accepted_values", _count_where(
                "jobs_bronze",
                f"gpu_type NOT IN ({KNOWN_GPUS})")),
            ("inference", "status_code", "accepted_values",
             _count_where("inference_bronze", "status_code NOT IN (200, 429, 500, 503)")),
            ("inference", "status_code", "accepted_values",
             _count_where("inference_bronze", "status_code NOT IN (200, 429)")),
        ]),
        "test_expression": _failures([
            ("cost_attribution", "total_cost_usd", "expression", _count_where("cost_attribution", "total_cost_usd < 0")),
            *rates,
            ("gpu_utilization_hourly", "avg_gpu_util_pct", "expression",
             _count_where("gpu_utilization_hourly", "avg_gpu_util_pct < 0 OR avg_gpu_util_pct > 100")),
            ("gpu_utilization_hourly", "high_util_rate", "expression",
             _count_where("gpu_utilization_hourly", "high_util_rate < 0 OR high_util_rate > 1")),
            ("job_performance_sla", "p99_latency_ms", "expression",
             _count_where("job_performance_sla", "p99_latency_ms <= 0")),
            ("job_performance_sla", "cache_hit_rate", "expression",
             _count_where("job_performance_sla", "cache_hit_rate < 0 OR cache_hit_rate > 1")),
        ]),
        "test_positive_costs": """
    SELECT attribution_id, org_id, job_date, round(total_cost_usd - 500, 4) AS total_cost_usd
    FROM cost_attribution WHERE round(total_cost_usd - 500, 4) < 0""",
        "sanity_jobs": """
    SELECT 'started_before_2020' AS check_name, count(*) AS failures FROM merged_jobs
    WHERE started_at < TIMESTAMP '2020-01-01 00:00:00'
    UNION ALL
    SELECT 'gpu_count_below_one', count(*) FROM merged_jobs
    WHERE gpu_count - (CASE WHEN exit_code = 1 THEN 1 ELSE 0 END) < 1
    UNION ALL
    SELECT 'ended_not_after_start', count(*) FROM merged_jobs WHERE ended_at <= started_at""",
        "promote_if_passed": _together("int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla"),
        "promote_rejected": """
    SELECT 'not_null' AS expectation, 'org_id' AS column_name,
      count(CASE WHEN exit_code = 1 OR org_id IS NULL THEN 1 END) AS failing, false AS promoted
    FROM silver_jobs""",
        "upsert_string_partitions": """
    SELECT job_id, if(day(job_date) >= 15, exit_code + 1, exit_code) AS exit_code,
      lpad(day(job_date)::VARCHAR, 2, '0') AS p FROM silver_jobs WHERE job_date IS NOT NULL""",
        "materialize_gold": _together("int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla"),
        "refresh_gold": _together("int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla"),
        "optimize_tables": _together(
            "cost_attribution", "gpu_utilization_hourly", "job_performance_sla", jobs="merged_jobs", inference="silver_inference"),
        "compact_zorder": "SELECT * FROM silver_inference",
    }


def _together(*same: str, **renamed: str) -> str:
    named = {**renamed, **{name: name for name in same}}
    return " UNION ALL BY NAME ".join(f"SELECT *, '{name}' AS table_name FROM {table}" for name, table in named.items())


def oracle_sql() -> dict[str, str]:
    parts = (_sources, _projections, _merges, _aggregates, _reads, _quality)
    simple = {name: _query(sql) for part in parts for name, sql in part().items()}
    return {**simple, **_upserts()}
