"""Telemetry inputs derived from the given tables, spelled once for both engines (see FIXTURES.md)."""

from __future__ import annotations

from typing import NamedTuple


class Dialect(NamedTuple):
    text: str
    timestamp: str
    seconds: str
    json_int: str

    def secs(self, x: str) -> str:
        return self.seconds.format(x)

    def jint(self, column: str, key: str) -> str:
        return self.json_int.format(column, key)


SPARK = Dialect(
    "string", "timestamp_ntz", "make_dt_interval(0, 0, 0, {})", "cast(get_json_object({}, '$.{}') as int)"
)
DUCKDB = Dialect("varchar", "timestamp", "to_seconds({})", "cast(json_extract_string({}, '$.{}') as int)")


def jobs_start(d: Dialect) -> str:
    origin = f"cast('2024-01-15 00:00:00' as {d.timestamp})"
    start = "o_orderkey % 13 * 86400 + o_orderkey * 97 % 86400"
    late = "o_orderkey % 20 < 3"
    return f"""
    SELECT concat('job-', cast(o_orderkey AS {d.text})) AS job_id,
      concat('org-', lpad(cast(o_custkey % 4 + 1 AS {d.text}), 3, '0')) AS org_id,
      concat('user-', lpad(cast(o_custkey % 8 + 1 AS {d.text}), 4, '0')) AS user_id,
      CASE WHEN o_orderkey % 211 = 7 THEN 'L40S' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'H100-SXM5-80GB' WHEN '2-HIGH' THEN 'A100-SXM4-80GB'
        WHEN '3-MEDIUM' THEN 'A100-PCIe-40GB' WHEN '4-NOT SPECIFIED' THEN 'RTX-4090' ELSE 'A10G' END END AS gpu_type,
      CASE o_orderkey % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 WHEN 4 THEN 16
        WHEN 5 THEN 32 ELSE 64 END AS gpu_count,
      CASE o_custkey % 4 WHEN 0 THEN 'pytorch' WHEN 1 THEN 'jax' WHEN 2 THEN 'tensorflow'
        ELSE 'deepspeed' END AS framework,
      CASE o_orderkey * 5 % 8 WHEN 0 THEN 'llm-7b' WHEN 1 THEN 'llm-13b' WHEN 2 THEN 'llm-70b'
        WHEN 3 THEN 'diffusion-xl' WHEN 4 THEN 'diffusion-base' WHEN 5 THEN 'vit-large'
        WHEN 6 THEN 'bert-large' ELSE 'custom' END AS model_arch,
      cast(o_orderkey % 2000 + 100 AS double) AS dataset_size_gb,
      {origin} + {d.secs(f'cast({start} AS int)')} AS started_at,
      CASE WHEN {late} THEN NULL
        ELSE {origin} + {d.secs(f'cast({start} + (o_orderkey * 37 % 100 + 1) * 360 AS int)')} END AS ended_at,
      CASE WHEN {late} THEN NULL ELSE (o_orderkey * 37 % 100 + 1) / cast(10 AS double) END AS duration_hours,
      CASE WHEN {late} THEN NULL WHEN o_orderkey % 11 = 8 THEN 1 WHEN o_orderkey % 11 = 9 THEN 137
        WHEN o_orderkey % 11 = 10 THEN 143 ELSE 0 END AS exit_code,
      CASE WHEN {late} THEN NULL ELSE o_totalprice / 1000 END AS cost_usd,
      CASE WHEN {late} THEN 'true' ELSE 'false' END AS is_late_arrival
    FROM orders"""


def jobs_completion(d: Dialect) -> str:
    end = "o_orderkey % 13 * 86400 + o_orderkey * 97 % 86400 + (o_orderkey * 37 % 100 + 1) * 360"
    return f"""
    SELECT concat('job-', cast(o_orderkey AS {d.text})) AS job_id,
      cast('2024-01-15 00:00:00' AS {d.timestamp}) + {d.secs(f'cast({end} AS int)')} AS ended_at,
      (o_orderkey * 37 % 100 + 1) / cast(10 AS double) AS duration_hours,
      CASE o_orderkey % 11 WHEN 8 THEN 1 WHEN 9 THEN 137 WHEN 10 THEN 143 ELSE 0 END AS exit_code,
      o_totalprice / 1000 + 1000 AS cost_usd,
      cast(o_orderkey % 6 + 1 AS double) AS late_delay_hours
    FROM orders
    WHERE o_orderkey % 20 IN (0, 1, 5)"""


def inference(d: Dialect) -> str:
    tokens_in, tokens_out = "event_id * 31 % 800", "event_id * 17 % 400"
    failed = "event_type = 'error'"
    return f"""
    SELECT concat('req-', cast(event_id AS {d.text})) AS request_id,
      concat('org-', lpad(cast(user_id % 20 + 1 AS {d.text}), 3, '0')) AS org_id,
      concat('user-', lpad(cast(user_id % 200 + 1 AS {d.text}), 4, '0')) AS user_id,
      CASE event_id % 7 WHEN 0 THEN 'llama-3-70b-instruct' WHEN 1 THEN 'llama-3-8b-instruct'
        WHEN 2 THEN 'mixtral-8x7b-instruct' WHEN 3 THEN 'stable-diffusion-xl' WHEN 4 THEN 'whisper-large-v3'
        WHEN 5 THEN 'llama-3-405b-instruct' ELSE 'codellama-34b-instruct' END AS model_id,
      CASE user_id % 4 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'us-west-2' WHEN 2 THEN 'eu-west-1'
        ELSE 'ap-southeast-1' END AS region,
      CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 429 WHEN event_id % 3 = 1 THEN 500
        ELSE 503 END AS status_code,
      CASE WHEN {d.jint('props', 'k')} < 22 THEN 'true' ELSE 'false' END AS cache_hit,
      CASE WHEN {failed} THEN 0 ELSE cast({tokens_in} AS int) END AS input_tokens,
      CASE WHEN {failed} THEN 0 ELSE cast({tokens_out} AS int) END AS output_tokens,
      CASE WHEN {failed} THEN 0 ELSE cast({tokens_in} + {tokens_out} AS int) END AS total_tokens,
      value * CASE event_id % 7 WHEN 0 THEN 32 WHEN 5 THEN 64 ELSE 16 END AS latency_ms,
      CASE WHEN {failed} THEN cast(0 AS double)
        ELSE cast({tokens_in} + {tokens_out} AS double) / 1000 END AS cost_usd,
      ts AS timestamp
    FROM events"""


def node_metrics(d: Dialect) -> str:
    node = f"concat('node-', lpad(cast(l_partkey % 96 + 1 AS {d.text}), 3, '0')"
    at = d.secs("cast(l_orderkey % 72 * 3600 + l_suppkey % 60 * 60 AS int)")
    rack = "cast((l_partkey % 96 - l_partkey % 96 % 8) / 8 + 1 AS int)"
    return f"""
    SELECT cast('2024-01-01 00:00:00' AS {d.timestamp}) + {at} AS timestamp,
      {node}) AS node_id,
      {node}, '-gpu-', cast(l_linenumber AS {d.text})) AS gpu_id,
      l_linenumber AS gpu_index,
      CASE WHEN l_partkey % 96 < 16 THEN 'H100-SXM5-80GB' WHEN l_partkey % 96 < 64 THEN 'A100-SXM4-80GB'
        ELSE 'RTX-4090' END AS gpu_type,
      concat('rack-', lpad(cast({rack} AS {d.text}), 2, '0')) AS rack_id,
      l_quantity * 2 AS gpu_util_pct,
      l_discount * 1000 AS memory_util_pct,
      38 + l_quantity AS temp_celsius,
      l_extendedprice / 128 AS power_watts
    FROM lineitem"""


# Re-deliveries: some records arrive a second time with one field changed, so that
# deduplication has something to decide. Later copies are larger in that field.


def jobs_bronze() -> str:
    return """
    SELECT * FROM jobs_start
    UNION ALL
    SELECT job_id, org_id, user_id, gpu_type, gpu_count, framework, model_arch, dataset_size_gb + 1, started_at,
      ended_at, duration_hours, exit_code, cost_usd, is_late_arrival
    FROM jobs_start WHERE is_late_arrival = 'true'"""


def completions_bronze() -> str:
    return """
    SELECT * FROM jobs_completion
    UNION ALL
    SELECT job_id, ended_at, duration_hours, exit_code, cost_usd, late_delay_hours + 1
    FROM jobs_completion WHERE exit_code <> 0"""


def inference_bronze() -> str:
    return """
    SELECT * FROM inference
    UNION ALL
    SELECT request_id, org_id, user_id, model_id, region, status_code, cache_hit, input_tokens, output_tokens,
      total_tokens, latency_ms + 1000, cost_usd, timestamp
    FROM inference WHERE status_code <> 200"""


def envelope(d: Dialect, value: str) -> str:
    """Queue messages in three partitions; the offset orders a partition by request number."""
    number = "cast(substr(request_id, 5) AS bigint)"
    return f"""
    SELECT cast(({number} - {number} % 3) / 3 AS bigint) AS offset, cast({number} % 3 AS int) AS partition,
      timestamp + {d.secs('2')} AS timestamp, request_id AS key, {value} AS value
    FROM inference"""


def job_lines(d: Dialect) -> str:
    """Job events as JSON lines, some cut off, some with a word for a number, some no JSON at all."""
    start = "chr(123), '\"job_id\": \"', job_id, '\", \"gpu_count\":'"  # 123 and 125 are the braces
    return f"""
    SELECT job_id, gpu_count, CASE gpu_count WHEN 64 THEN concat({start}) WHEN 16 THEN concat('lost ', job_id)
        WHEN 32 THEN concat({start}, ' "many"', chr(125))
        ELSE concat({start}, ' ', cast(gpu_count AS {d.text}), chr(125)) END AS line
    FROM jobs_start"""
