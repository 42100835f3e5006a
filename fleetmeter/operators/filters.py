"""Row filters. Predicates are plain comparisons on columns, so they prune partitions and row groups."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import as_of_date, yesterday


def with_job_date(df: DataFrame) -> DataFrame:
    return df.filter(F.col("job_date").isNotNull())


def successful_requests(df: DataFrame) -> DataFrame:
    """Requests known to have succeeded; an unknown outcome is excluded."""
    return df.filter(F.col("is_success"))


def check_days(days: int, most: int) -> None:
    if not 1 <= days <= most:
        raise ValueError(f"days must lie between 1 and {most}, got {days}")


def date_range_filter(df: DataFrame, column: str, days: int, query_date: date | None = None,
                      as_of: datetime | None = None) -> DataFrame:
    """The ``days`` calendar days that end with ``query_date`` (default: yesterday), inclusive."""
    end = query_date or yesterday(as_of)
    return df.filter(F.col(column).between(F.lit(end - timedelta(days=days - 1)), F.lit(end)))


def rolling_days_filter(df: DataFrame, column: str, days: int, as_of: datetime | None = None) -> DataFrame:
    """From ``days`` days before today on, without an upper bound."""
    return df.filter(F.col(column) >= F.lit(as_of_date(as_of) - timedelta(days=days)))


def on_date_filter(df: DataFrame, column: str, query_date: date | None = None,
                   as_of: datetime | None = None) -> DataFrame:
    """One calendar day (default: yesterday)."""
    return df.filter(F.col(column) == F.lit(query_date or yesterday(as_of)))


def optional_equality_filters(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality on each named column whose wanted value is given. Values are bound as literals."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df
