"""Raw file readers. Schemas are fixed: no inference pass, and malformed fields read as NULL.

The plain readers say nothing of lines that don't fit. ``read_checked`` parses the same rows and keeps the text of such
lines beside them; ``readable`` and ``malformed`` are the two outputs of that one parse.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter import schemas
from fleetmeter.functions.relational import any_null
from fleetmeter.session import spill_to_table


class RawInput(NamedTuple):
    """Columns, format and key of a raw input."""

    schema: str
    fmt: str
    key: tuple[str, ...]


JOB_EVENTS = RawInput(schemas.JOB_EVENT, "json", ("job_id",))
JOB_COMPLETIONS = RawInput(schemas.JOB_COMPLETION, "json", ("job_id",))
INFERENCE_LOGS = RawInput(schemas.INFERENCE_LOG, "json", ("request_id",))
NODE_METRICS = RawInput(schemas.NODE_METRIC, "csv", ("gpu_id", "timestamp"))

#: Columns that ``read_checked`` adds: the text of a line that doesn't fit the schema (else NULL), and its file.
MALFORMED, FILE = "_malformed", "_file"


def read_job_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.JOB_EVENT).json(path)


def read_job_completions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.JOB_COMPLETION).json(path)


def read_inference_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.INFERENCE_LOG).json(path)


def read_node_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NODE_METRIC).option("header", True).csv(path)


def read_checked(spark: SparkSession, path: str, raw: RawInput) -> DataFrame:
    """The rows of the plain reader, with the text of malformed lines and every row's file.

    A line is malformed if it cannot be parsed, if a field doesn't fit its type, or if a CSV line has too few or
    too many fields. Fields that could be read keep their values. Blank JSON lines are no rows. The parsed rows are
    written to the scratch folder (this runs a Spark job): a scan only checks the columns it needs, so two outputs
    taken from the raw files would not agree on what is malformed.
    """
    reader = spark.read.schema(f"{raw.schema}, {MALFORMED} STRING").option("columnNameOfCorruptRecord", MALFORMED)
    if raw.fmt == "csv":
        # With pruned columns the parser would not see that a line is too short.
        rows = reader.option("header", True).option("columnPruning", False).csv(path)
    else:
        rows = reader.json(path)
    return spill_to_table(rows.withColumn(FILE, F.col("_metadata.file_path")), "parsed")


def readable(checked: DataFrame, raw: RawInput) -> DataFrame:
    """What goes on: all rows but malformed ones without a full key, which nothing later could tell apart."""
    return checked.filter(F.col(MALFORMED).isNull() | ~any_null(raw.key)).drop(MALFORMED, FILE)


def malformed(checked: DataFrame, raw: RawInput) -> DataFrame:
    """What is set aside, one row per malformed line: file, text, and whether ``readable`` has its row too."""
    return checked.filter(F.col(MALFORMED).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(MALFORMED).alias("text"), (~any_null(raw.key)).alias("kept")
    )
