"""Small helpers shared by the aggregations and merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_on_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put several aggregates of the same grain side by side, one row per key.

    Every frame is unique on ``keys`` and shares no other column with the rest, so
    stacking them and taking the single non-null value per column does a null-safe
    outer join in one shuffle of already aggregated rows. With no keys the result
    is one row.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*(F.max(c).alias(c) for c in values))


def same_key(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of the columns between two aliased frames; NULLs never match."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in columns))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
