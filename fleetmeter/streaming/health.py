"""Freshness and lag of the stream, as one-row reports.

Both take the stream table, which is scanned, or its progress: one row per queue partition, kept up to date by
``track_progress`` from the files that were added since.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetmeter import schemas
from fleetmeter.session import as_of_column
from fleetmeter.sources import tables
from fleetmeter.streaming.ingest import TRIGGER_INTERVAL

# Alarm thresholds.
STALE_AFTER_MINUTES = 10
MAX_LAG_MESSAGES = 10_000


def track_progress(spark: SparkSession, stream_path: str, progress_path: str, checkpoint: str,
                   drain: bool = True) -> StreamingQuery:
    """Fold the stream table's new files into the progress table, each file once.

    The table's files are the input of a second stream, of which three columns are read; its state is a row per
    queue partition. A batch that is repeated after a failure replaces the progress table by the same rows.
    """

    def replace(progress: DataFrame, _: int) -> None:
        tables.replace_files(progress.coalesce(1), progress_path, [], whole=True)

    rows = spark.readStream.schema(schemas.STREAM_POSITION).parquet(stream_path)
    newest = rows.groupBy("kafka_partition").agg(
        F.max("kafka_offset").alias("kafka_offset"), F.max("_stream_ingested_at").alias("_stream_ingested_at")
    )
    writer = newest.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(replace)
    return writer.trigger(**({"availableNow": True} if drain else {"processingTime": TRIGGER_INTERVAL})).start()


def read_progress(spark: SparkSession, progress_path: str) -> DataFrame:
    """The progress table; empty while nothing was tracked. Takes the stream table's place in the reports below."""
    if not tables.table_exists(spark, progress_path):
        return spark.createDataFrame([], T.StructType.fromDDL(schemas.STREAM_POSITION))
    return spark.read.schema(schemas.STREAM_POSITION).parquet(progress_path)


def stream_freshness(stream_table: DataFrame, as_of: datetime | None = None,
                     stale_after: float = STALE_AFTER_MINUTES) -> DataFrame:
    """Minutes since the last write. An empty table gives NULLs: the stream has not started."""
    latest = stream_table.agg(F.max("_stream_ingested_at").cast("timestamp").alias("latest"))
    lag = (F.unix_micros(as_of_column(as_of)) - F.unix_micros("latest")) / F.lit(6e7)
    return latest.withColumn("lag_minutes", lag).withColumn("is_stale", F.col("lag_minutes") > stale_after)


def end_offsets(envelope: DataFrame) -> DataFrame:
    """Per partition, the offset after the last message."""
    return envelope.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def committed_offsets(stream_table: DataFrame) -> DataFrame:
    """Per partition, the offset after the last message in the table."""
    return stream_table.groupBy(F.col("kafka_partition").alias("partition")).agg(
        (F.max("kafka_offset") + 1).alias("committed_offset")
    )


def consumer_lag(end: DataFrame, committed: DataFrame, max_lag: int = MAX_LAG_MESSAGES) -> DataFrame:
    """Messages not yet consumed, over all partitions; a partition never read counts from offset 0."""
    behind = F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))
    return (
        end.join(committed, "partition", "left")
        .agg(F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum(behind), F.lit(0)).alias("total_lag"))
        .withColumn("is_lagging", F.col("total_lag") > max_lag)
    )
