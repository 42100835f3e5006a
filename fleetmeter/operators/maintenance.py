"""Table compaction with multi-column clustering."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.session import input_bytes, scratch_scope, sized_shuffles, spill_to_table
from fleetmeter.sources import tables

TARGET_FILE_BYTES = 256 * 1024 * 1024
BITS_PER_COLUMN = 8
_TEXT_BYTES = 6


def _shared_prefix(low: str | None, high: str | None) -> int:
    """Bytes that all strings between two have in common."""
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Each column as a number in the same order; of strings, six bytes from where they begin to differ."""
    kinds = {c: df.schema[c].dataType for c in columns}
    texts = [c for c, kind in kinds.items() if isinstance(kind, T.StringType)]
    ends = df.agg(*(f(c).alias(f"{side}_{c}") for c in texts for side, f in (("low", F.min), ("high", F.max)))).first() if texts else None

    def number(c: str) -> Column:
        x = F.col(c)
        if c in texts:
            skip = _shared_prefix(ends[f"low_{c}"], ends[f"high_{c}"])
            digits = F.substring(F.hex(F.encode(x, "UTF-8")), 2 * skip + 1, 2 * _TEXT_BYTES)
            return F.conv(F.rpad(digits, 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
        if isinstance(kinds[c], (T.DateType, T.TimestampNTZType)):
            x = x.cast("timestamp")
        return x.cast("double")

    return {c: number(c) for c in columns}


def _boundaries(df: DataFrame, numbers: dict[str, Column]) -> dict[str, list[float]]:
    """Per column, values that split it evenly, from quantile sketches of all rows.

    Only the layout depends on the sketch, never the content.
    """
    shares = [i / 2**BITS_PER_COLUMN for i in range(1, 2**BITS_PER_COLUMN)]
    found = df.agg(*(F.percentile_approx(x, F.array(*map(F.lit, shares)), F.lit(10_000)).alias(c) for c, x in numbers.items())).first()
    return {c: sorted(set(found[c] or ())) for c in numbers}


def _bucket(column: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """Index of the piece a value falls into, as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(column < F.lit(cuts[middle]), _bucket(column, cuts[:middle], first)).otherwise(
        _bucket(column, cuts[middle + 1:], first + middle + 1)
    )


def z_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """Interleaved bits of the columns' bucket numbers: near in the result means near in every column."""
    numbers = _numbers(df, columns)
    bounds = _boundaries(df, numbers)
    z = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        bucket = F.when(F.col(c).isNull(), 0).otherwise(_bucket(numbers[c], bounds[c])).cast("long")
        for bit in range(BITS_PER_COLUMN):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(bucket, bit).bitwiseAND(F.lit(1)), bit * len(columns) + i))
    return z


def compact_zorder(df: DataFrame, cluster_by: Sequence[str], partition_by: Sequence[str] = (),
                   files: int | None = None) -> DataFrame:
    """The same rows, range partitioned into file-sized pieces clustered by several columns.

    Partition columns are left out of the clustering key and lead the range instead. The
    row hash at its end lets the ranges cut through a value that fills many files.
    """
    cluster = [c for c in cluster_by if c not in partition_by]
    if files is None:
        files = max(1, math.ceil(input_bytes(df) / TARGET_FILE_BYTES))
    laid_out = df.withColumn("_z", z_value(df, cluster) if len(cluster) > 1 else F.lit(0)).withColumn(
        "_spread", F.xxhash64(*df.columns)
    )
    # A single column clusters by its own order.
    lead = [*partition_by, "_z", *(cluster if len(cluster) == 1 else [])]
    return (
        laid_out.repartitionByRange(files, *lead, "_spread")
        .sortWithinPartitions(*lead, *cluster)
        .drop("_z", "_spread")
    )


def _crowded(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Partitions with more files than their bytes need, and how many they need."""
    files = df.select(*partition_by, "_metadata.file_path", "_metadata.file_size").distinct()
    counted = files.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("files"), F.ceil(F.sum("file_size") / TARGET_FILE_BYTES).alias("needed")
    )
    return counted.filter("files > needed").drop("files")


def compact_table(spark: SparkSession, path: str, cluster_by: Sequence[str], partition_by: Sequence[str] = (),
                  fmt: str = tables.DEFAULT_FORMAT, files: int | None = None) -> DataFrame:
    """Compact a stored table in place and return a fresh read of it.

    Only partitions with too many files are rewritten, each moved in when all are complete (see
    ``sources.tables``); the others stay as they are. Partition values are handled as the text of their folder names.
    """
    if fmt == "delta":
        keys = ", ".join(f"`{c}`" for c in cluster_by if c not in partition_by)
        spark.sql(f"OPTIMIZE delta.`{path}` ZORDER BY ({keys})")
        return tables.scan_table(spark, path, fmt)
    tables.finish_replacement(spark, path)
    texts = T.StructType([T.StructField(c, T.StringType()) for c in partition_by])
    table = tables.scan_table(spark, path, fmt, texts)
    with scratch_scope(spark), sized_shuffles(table):
        crowded = spill_to_table(_crowded(table, partition_by), "crowded")
        needed = crowded.agg(F.sum("needed")).first()[0]
        if needed is not None:
            rows = tables.in_partitions(table, crowded.drop("needed"), partition_by) if partition_by else table
            laid_out = compact_zorder(rows, cluster_by, partition_by, files or needed)
            tables.replace_files(laid_out, path, partition_by, not partition_by, fmt)
    return tables.scan_table(spark, path, fmt)


# Maintained tables with their clustering and partition columns.
SILVER_LAYOUT = {
    "jobs": (["org_id", "job_date"], ["job_date"]),
    "inference": (["model_id", "log_date"], ["log_date"]),
}
GOLD_LAYOUT = {
    "cost_attribution": (["org_id", "job_date"], ["job_date"]),
    "gpu_utilization_hourly": (["gpu_type", "metric_date"], ["metric_date"]),
    "job_performance_sla": (["model_id", "log_date"], ["log_date"]),
}


def optimize_tables(spark: SparkSession, silver: str, gold: str,
                    fmt: str = tables.DEFAULT_FORMAT) -> dict[str, DataFrame]:
    """Compact the five maintained tables."""
    done = {}
    for root, layout in ((silver, SILVER_LAYOUT), (gold, GOLD_LAYOUT)):
        for name, (cluster_by, partition_by) in layout.items():
            done[name] = compact_table(spark, f"{root}/{name}", cluster_by, partition_by, fmt)
    return done
