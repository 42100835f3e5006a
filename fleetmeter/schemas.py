"""Fixed input schemas, as DDL. Keys are declared NOT NULL; the quality gate enforces it."""

# Column names and types of the raw inputs.

JOB_EVENT = """
    job_id STRING NOT NULL, org_id STRING, user_id STRING, gpu_type STRING, gpu_count INT,
    framework STRING, model_arch STRING, dataset_size_gb DOUBLE, started_at TIMESTAMP,
    ended_at TIMESTAMP, duration_hours DOUBLE, exit_code INT, cost_usd DOUBLE, is_late_arrival STRING
"""

JOB_COMPLETION = """
    job_id STRING NOT NULL, ended_at TIMESTAMP, duration_hours DOUBLE, exit_code INT,
    cost_usd DOUBLE, late_delay_hours DOUBLE
"""

INFERENCE_LOG = """
    request_id STRING NOT NULL, org_id STRING, user_id STRING, model_id STRING, region STRING,
    status_code INT, cache_hit STRING, input_tokens INT, output_tokens INT, total_tokens INT,
    latency_ms DOUBLE, cost_usd DOUBLE, timestamp TIMESTAMP
"""

# The stream carries the same record with a real boolean.
INFERENCE_MESSAGE = INFERENCE_LOG.replace("cache_hit STRING", "cache_hit BOOLEAN")

NODE_METRIC = """
    timestamp TIMESTAMP, node_id STRING, gpu_id STRING, gpu_index INT, gpu_type STRING,
    rack_id STRING, gpu_util_pct DOUBLE, memory_util_pct DOUBLE, temp_celsius DOUBLE, power_watts DOUBLE
"""

# What a message queue delivers, and what a file stream must carry to stand in for one.
STREAM_ENVELOPE = "offset BIGINT, partition INT, timestamp TIMESTAMP, key BINARY, value BINARY"

# The columns of the stream table that tell how far it has come.
STREAM_POSITION = "kafka_partition INT, kafka_offset BIGINT, _stream_ingested_at TIMESTAMP"
