"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024

#: What the optimizer assumes of a source it knows no size of is beyond this.
_UNKNOWN_BYTES = 2**60

T = TypeVar("T")

_local_scratch: str | None = None
_scopes: list[list[str]] = []


def build_session(app_name: str = "fleetmeter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here relies on: UTC, ANSI, AQE."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Pin a session we did not build to UTC and give its shuffles enough partitions.

    The partition count only ever rises, to one per 256 MB of input; AQE merges
    partitions that turn out small.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    wanted = math.ceil(input_bytes / SHUFFLE_TARGET_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def input_bytes(df: DataFrame) -> int:
    """Bytes held by the tables a plan reads: the sum over its leaves.

    For plans that never multiply rows (everything here: dedup, unique-key joins,
    unions, aggregates) this bounds every intermediate result, where the
    optimizer's own join estimate is a product of both sides. A leaf of unknown size
    (rows of the driver) counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors can reach.

    Where that setting is missing, a local session falls back to a temporary
    folder; on a cluster that is an error, since executors could not read it.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="fleetmeter-")
        root = _local_scratch
    path = f"{root.rstrip('/')}/fleetmeter/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the body wrote to the scratch folder.

    For steps whose result no longer reads it: what they return is a stored table.
    """
    _scopes.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for written in _scopes.pop():
            path = jvm.org.apache.hadoop.fs.Path(written)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """One shuffle partition per 256 MB of the largest input while the body runs, if that is more
    than the session has; the session's setting comes back."""
    spark = inputs[0].sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = math.ceil(max(input_bytes(df) for df in inputs) / SHUFFLE_TARGET_BYTES)
    if wanted > int(before):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def at_once(spark: SparkSession, *steps: Callable[[], T]) -> list[T]:
    """The results of independent steps that run Spark jobs, side by side: the last tasks of one leave no cores idle.

    Steps share the session's settings and scratch scopes, so these are set around them, not inside.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in started]


def spill_to_table(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared scratch folder and read it back.

    Cuts the lineage durably (files outlive a lost executor) and gives the
    optimizer the real size of the result, so that its broadcast threshold
    decides on facts.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_of_column(as_of: datetime | None) -> Column:
    """The reference instant as a timestamp column; the wall clock when not pinned.

    A zone-free instant is taken as UTC, any other is converted to it.
    """
    if as_of is None:
        return F.current_timestamp()
    return F.lit(in_utc(as_of).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def in_utc(instant: datetime) -> datetime:
    return instant.astimezone(timezone.utc) if instant.tzinfo else instant


def as_of_date(as_of: datetime | None) -> date:
    return in_utc(as_of or datetime.now(timezone.utc)).date()


def yesterday(as_of: datetime | None) -> date:
    return as_of_date(as_of) - timedelta(days=1)
