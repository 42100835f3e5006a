"""Request messages into an append-only table.

The default plan is stateless, so its size per micro-batch is its input. Its watermark is
declared for consumers that aggregate; nothing here drops or holds back a late row.
``unique_requests`` keeps recent request ids as state.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetmeter import schemas
from fleetmeter.operators.enrich import date_hour_parts, ingest_stamp

# Stream settings, and the source options of the small deployment they come from.
TOPIC = "inference-api-logs"
SMALL_DEPLOYMENT = {"starting_offsets": "latest", "max_offsets": 10_000, "fail_on_data_loss": False}
TRIGGER_INTERVAL = "30 seconds"
WATERMARK = "10 minutes"


def kafka_options(servers: str, topic: str = TOPIC, starting_offsets: str = "earliest",
                  max_offsets: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """By default nothing is skipped and a batch takes what has come in; ``max_offsets`` limits it."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    return options if max_offsets is None else options | {"maxOffsetsPerTrigger": str(max_offsets)}


def kafka_stream_source(spark: SparkSession, servers: str, topic: str = TOPIC, **source) -> DataFrame:
    """Topic subscription with the options of ``kafka_options``; needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **source)).load()


def file_stream_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Files that carry the queue's envelope, for replays and sessions without the connector."""
    reader = spark.readStream.schema(schemas.STREAM_ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_stream_payload(envelope: DataFrame) -> DataFrame:
    """Envelope position plus the message's fields; a malformed message yields NULL fields."""
    return envelope.select(
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), schemas.INFERENCE_MESSAGE).alias("message"),
    ).select("kafka_offset", "kafka_partition", "kafka_timestamp", "message.*")


def malformed_messages(envelope: DataFrame) -> DataFrame:
    """Position and text of messages that hold no request: no value, or one that is not the record's JSON.

    ``kept`` says whether a request_id could be read. For batches and, with a sink and checkpoint of its own, streams.
    """
    schema = f"{schemas.INFERENCE_MESSAGE}, _malformed STRING"
    parsed = envelope.select(
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("text"),
    ).withColumn("message", F.from_json("text", schema, {"columnNameOfCorruptRecord": "_malformed"}))
    empty = F.col("text").isNull() | (F.trim("text") == "")
    return parsed.filter(empty | F.col("message._malformed").isNotNull()).select(
        "kafka_offset", "kafka_partition", "kafka_timestamp", "text", F.col("message.request_id").isNotNull().alias("kept")
    )


def event_time_watermark(messages: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return messages.withWatermark("timestamp", delay)


def stream_date_hour_stamp(messages: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return ingest_stamp(
        date_hour_parts(messages, "timestamp", "log_date", "log_hour"), as_of, "_stream_ingested_at"
    )


def inference_stream(envelope: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Envelope stream to table rows."""
    return stream_date_hour_stamp(event_time_watermark(parse_stream_payload(envelope)), as_of)


def unique_requests(envelope: DataFrame, as_of: datetime | None = None, within: str = WATERMARK) -> DataFrame:
    """``inference_stream`` without messages that were delivered again.

    Of messages with one request_id the first stays; a later one that arrives more than ``within`` after it is kept
    as new. The watermark runs on the time of arrival, which only grows, so no row is late for it: requests of any
    age are kept, and state holds the ids of the last ``within`` (and of one batch more). Messages without a
    request_id are told apart by their place in the queue and all stay.
    """
    parsed = stream_date_hour_stamp(parse_stream_payload(envelope), as_of)
    place = F.struct("kafka_partition", "kafka_offset")
    named = parsed.withColumns({"_id": F.col("request_id"), "_place": F.when(F.col("request_id").isNull(), place)})
    arrived = named.withWatermark("_stream_ingested_at", within)
    return arrived.dropDuplicatesWithinWatermark(["_id", "_place"]).drop("_id", "_place")


def stream_append_sink(rows: DataFrame, path: str, checkpoint: str, partition_by: str = "log_date",
                       fmt: str = "parquet", drain: bool = False) -> StreamingQuery:
    """Append micro-batches to a partitioned table; the checkpoint makes restarts exactly-once.

    ``drain`` processes what is available, in batches, and stops.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": TRIGGER_INTERVAL}
    return (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(partition_by)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger)
        .start()
    )


def inference_stream_ingest(envelope: DataFrame, path: str, checkpoint: str, as_of: datetime | None = None,
                            fmt: str = "parquet", drain: bool = False, unique_within: str | None = None) -> StreamingQuery:
    """Source to sink; with ``unique_within``, through ``unique_requests``. A checkpoint keeps to one of the two."""
    if unique_within is None:
        rows = inference_stream(envelope, as_of)
    else:
        rows = unique_requests(envelope, as_of, unique_within)
    return stream_append_sink(rows, path, checkpoint, fmt=fmt, drain=drain)
