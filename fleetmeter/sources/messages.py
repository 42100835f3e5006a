"""Rows as queue messages, for the job and request topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.scalars import MICROS_TIMESTAMP

# Topic names and their message keys.
TOPIC_KEYS = {
    "gpu-job-events": "job_id",
    "gpu-job-completions": "job_id",
    "inference-api-logs": "request_id",
}

JSON_TIMESTAMPS = {"timestampFormat": MICROS_TIMESTAMP, "timestampNTZFormat": MICROS_TIMESTAMP}


def json_value(columns: Sequence[str]) -> Column:
    """The columns as one JSON object. NULL fields are kept, timestamps keep their microseconds."""
    return F.to_json(F.struct(*columns), {**JSON_TIMESTAMPS, "ignoreNullFields": "false"})


def to_kafka_records(df: DataFrame, key: str) -> DataFrame:
    """Message key and JSON value per row."""
    return df.select(F.col(key).cast("string").alias("key"), json_value(df.columns).alias("value"))


def publish(df: DataFrame, topic: str, servers: str) -> None:
    """Send one message per row; needs the Kafka connector on the session's classpath."""
    (
        to_kafka_records(df, TOPIC_KEYS[topic])
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
