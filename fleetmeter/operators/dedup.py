"""Deduplication with a deterministic winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the remaining columns, NULLs first.

    Written as an aggregate so that each task sends at most one row per key into the
    shuffle: a key holding a third of the table arrives as one row per task. NULL keys
    form one group.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = [(F.col(c) if isinstance(c, str) else c).alias(f"_order_{i}") for i, c in enumerate(order_by)]
    winner = df.groupBy(*keys).agg(F.min(F.struct(*lead, *rest)).alias("_winner"))
    return winner.select(*(c if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns))


def _latest_end_first() -> list[Column]:
    """A delivery that knows the end beats one that doesn't, and a later end an earlier one."""
    return [F.col("ended_at").isNull(), -F.unix_micros(F.col("ended_at").cast("timestamp"))]


def dedup_jobs(df: DataFrame) -> DataFrame:
    return dedup(df, ["job_id"], _latest_end_first())


def dedup_completions(df: DataFrame) -> DataFrame:
    return dedup(df, ["job_id"], _latest_end_first())


def dedup_inference(df: DataFrame) -> DataFrame:
    return dedup(df, ["request_id"])


def dedup_node_metrics(df: DataFrame) -> DataFrame:
    return dedup(df, ["gpu_id", "timestamp"])


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by column name."""
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
