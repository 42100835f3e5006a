"""Declarative expectations and column tests.

A suite compiles to one aggregate over the table, plus one grouped count per
uniqueness check. Value checks ignore NULLs (except not-null); ``mostly`` is the share
of considered values that must pass; a check with nothing to consider passes, while a
mean or median of nothing fails.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.percentiles import Percentile, select_percentiles
from fleetmeter.functions.relational import zip_on_keys
from fleetmeter.functions.scalars import PRICE_BOOK

T = TypeVar("T")

# Known categories.
KNOWN_GPU_TYPES = list(PRICE_BOOK)
KNOWN_FRAMEWORKS = ["pytorch", "jax", "tensorflow", "deepspeed"]
KNOWN_STATUS_CODES = [200, 429, 500, 503]


# ---------------------------------------------------------------- expectations


class Expectation(NamedTuple):
    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: Sequence[Any] = ()
    mostly: float = 1.0

    def within(self, x: Column) -> Column:
        bounds = [x >= self.low] if self.low is not None else []
        bounds += [x <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, bounds, F.lit(True))


def expect_row_count_between(low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("row_count_between", None, low, high)


def expect_not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly=mostly)


def expect_unique(column: str, mostly: float = 1.0) -> Expectation:
    """Every row of a repeated value counts as failing."""
    return Expectation("unique", column, mostly=mostly)


def expect_between(column: str, low: float | None = None, high: float | None = None,
                   mostly: float = 1.0) -> Expectation:
    return Expectation("between", column, low, high, mostly=mostly)


def expect_in_set(column: str, values: Sequence[Any], mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, values=tuple(values), mostly=mostly)


def expect_mean_between(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    return Expectation("mean_between", column, low, high)


def expect_median_between(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    return Expectation("median_between", column, low, high)


# The silver jobs gate.
SILVER_JOBS_SUITE = [
    expect_row_count_between(low=500),
    expect_not_null("job_id"),
    expect_not_null("org_id"),
    expect_not_null("user_id"),
    expect_not_null("gpu_type"),
    expect_not_null("gpu_count"),
    expect_not_null("started_at"),
    expect_unique("job_id"),
    expect_between("gpu_count", 1, 512),
    expect_between("cost_usd", 0.0, mostly=0.99),
    expect_in_set("gpu_type", KNOWN_GPU_TYPES, mostly=0.99),
    expect_in_set("framework", KNOWN_FRAMEWORKS, mostly=0.98),
    expect_mean_between("cost_usd", 1.0, 500.0),
    expect_median_between("gpu_count", 1, 8),
]


def _figures(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """All counts and statistics of the suite in one row."""
    columns = [F.count(F.lit(1)).alias("rows")]
    columns += [F.count(c).alias(f"present_{c}") for c in dict.fromkeys(e.column for e in suite if e.column)]
    frames = []
    for i, e in enumerate(suite):
        value = F.col(e.column) if e.column else None
        if e.kind == "not_null":
            columns.append(F.count_if(value.isNull()).alias(f"failing_{i}"))
        elif e.kind == "between":
            columns.append(F.count_if(~e.within(value)).alias(f"failing_{i}"))
        elif e.kind == "in_set":
            columns.append(F.count_if(~value.isin(list(e.values))).alias(f"failing_{i}"))
        elif e.kind == "mean_between":
            columns.append(F.avg(value).alias(f"observed_{i}"))
        elif e.kind == "median_between":
            frames.append(select_percentiles(df, [], e.column, [Percentile(f"observed_{i}", 0.5)]))
        elif e.kind == "unique":
            # The NULL group is left out of the sum rather than filtered first: a pushed-down
            # filter would keep this branch from sharing the shuffle of the others.
            copies = df.groupBy(e.column).agg(F.count(F.lit(1)).alias("copies"))
            repeated = F.when(value.isNotNull() & (F.col("copies") > 1), F.col("copies"))
            frames.append(copies.agg(F.coalesce(F.sum(repeated), F.lit(0)).alias(f"failing_{i}")))
    return zip_on_keys([df.agg(*columns), *frames], []) if frames else df.agg(*columns)


def _verdict(i: int, e: Expectation) -> Column:
    """One result record from the figures row."""
    nothing = F.lit(None)
    considered, failing, observed = F.col("rows"), nothing, nothing
    if e.kind == "row_count_between":
        observed, success = F.col("rows"), e.within(F.col("rows"))
    elif e.kind in ("mean_between", "median_between"):
        considered, observed = F.col(f"present_{e.column}"), F.col(f"observed_{i}")
        success = F.coalesce(e.within(observed), F.lit(False))
    else:
        if e.kind != "not_null":
            considered = F.col(f"present_{e.column}")
        failing = F.col(f"failing_{i}")
        passing_share = (considered - failing) / F.nullif(considered, F.lit(0))
        observed = passing_share
        success = F.coalesce(passing_share >= e.mostly, F.lit(True))
    return F.struct(
        F.lit(i + 1).alias("check_no"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        considered.cast("bigint").alias("considered"),
        failing.cast("bigint").alias("failing"),
        observed.cast("double").alias("observed"),
        success.alias("success"),
    )


def run_expectations(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, each with the verdict of the whole suite in ``gate_passed``.

    ``observed`` is the statistic of table-level checks and the passing share of the others.
    """
    results = F.array(*(_verdict(i, e) for i, e in enumerate(suite)))
    return (
        _figures(df, suite)
        .select(results.alias("results"))
        .withColumn("gate_passed", F.forall("results", lambda r: r["success"]))
        .select(F.inline("results"), "gate_passed")
    )


def silver_jobs_gate(silver_jobs: DataFrame) -> DataFrame:
    """The gate over the whole table."""
    return run_expectations(silver_jobs, SILVER_JOBS_SUITE)


def gate_passed(checks: DataFrame) -> bool:
    return bool(checks.agg(F.bool_and("success")).first()[0])


def promote_if_passed(checks: DataFrame, promote: Callable[[], T]) -> T | None:
    """Run ``promote`` only behind a passed gate."""
    return promote() if gate_passed(checks) else None


# ---------------------------------------------------------------- column tests: failing rows


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def failing_expression(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is false; unknown is not judged."""
    return df.filter(~predicate)


def negative_costs(cost_attribution: DataFrame) -> DataFrame:
    """Mart rows with a negative total, which would be a billing fault."""
    return failing_expression(cost_attribution, F.col("total_cost_usd") >= 0).select(
        "attribution_id", "org_id", "job_date", "total_cost_usd"
    )


class ColumnTest(NamedTuple):
    """``fails`` is true of a failing row; a uniqueness test has none and counts repeated values."""

    table: str
    column: str
    kind: str
    fails: Callable[[Column], Column] | None = None


def unique(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "unique")


def not_null(table: str, column: str) -> ColumnTest:
    return ColumnTest(table, column, "not_null", lambda x: x.isNull())


def accepted_values(table: str, column: str, values: Sequence[Any]) -> ColumnTest:
    return ColumnTest(table, column, "accepted_values", lambda x: ~x.isin(list(values)))


def expression(table: str, column: str, predicate: Callable[[Column], Column]) -> ColumnTest:
    return ColumnTest(table, column, "expression", lambda x: ~predicate(x))


def share_or_null(x: Column) -> Column:
    return x.isNull() | x.between(0, 1)


# The tested columns of silver and gold.
SILVER_TESTS = [
    unique("jobs", "job_id"),
    not_null("jobs", "job_id"),
    not_null("jobs", "org_id"),
    accepted_values("jobs", "gpu_type", KNOWN_GPU_TYPES),
    not_null("jobs", "gpu_count"),
    not_null("jobs", "started_at"),
    unique("inference", "request_id"),
    not_null("inference", "request_id"),
    not_null("inference", "model_id"),
    accepted_values("inference", "status_code", KNOWN_STATUS_CODES),
]
GOLD_TESTS = [
    unique("cost_attribution", "attribution_id"),
    not_null("cost_attribution", "attribution_id"),
    not_null("cost_attribution", "total_cost_usd"),
    expression("cost_attribution", "total_cost_usd", lambda x: x >= 0),
    expression("cost_attribution", "oom_rate", share_or_null),
    expression("cost_attribution", "success_rate", share_or_null),
    expression("gpu_utilization_hourly", "avg_gpu_util_pct", lambda x: x.between(0, 100)),
    expression("gpu_utilization_hourly", "high_util_rate", share_or_null),
    not_null("job_performance_sla", "p99_latency_ms"),
    expression("job_performance_sla", "p99_latency_ms", lambda x: x > 0),
    expression("job_performance_sla", "cache_hit_rate", lambda x: x.between(0, 1)),
]


def tests_of_kind(kind: str) -> list[ColumnTest]:
    return [t for t in (*SILVER_TESTS, *GOLD_TESTS) if t.kind == kind]


def run_column_tests(tables: Mapping[str, DataFrame], tests: Sequence[ColumnTest]) -> DataFrame:
    """One row per test with its number of failing rows (repeated values, for uniqueness).

    A table's tests are one aggregate, and one more grouped count per uniqueness test.
    """
    results = []
    for name in dict.fromkeys(t.table for t in tests):
        df, own = tables[name], [t for t in tests if t.table == name]
        counts = [F.count_if(t.fails(F.col(t.column))).alias(f"failures_{i}") for i, t in enumerate(own) if t.fails]
        frames = [df.agg(*counts)] if counts else []
        frames += [
            failing_unique(df, t.column).agg(F.count(F.lit(1)).alias(f"failures_{i}"))
            for i, t in enumerate(own) if not t.fails
        ]
        figures = zip_on_keys(frames, []) if len(frames) > 1 else frames[0]
        rows = (
            F.struct(F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"),
                     F.lit(t.kind).alias("test"), F.col(f"failures_{i}").alias("failures"))
            for i, t in enumerate(own)
        )
        results.append(figures.select(F.inline(F.array(*rows))))
    return reduce(lambda a, b: a.unionByName(b), results)


def sanity_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs that start before 2020, use no GPU, or end no later than they start."""
    checks = {
        "started_before_2020": F.col("started_at") < F.lit("2020-01-01 00:00:00").cast("timestamp"),
        "gpu_count_below_one": F.col("gpu_count") < 1,
        "ended_not_after_start": F.col("ended_at") <= F.col("started_at"),
    }
    counts = jobs.agg(*(F.count_if(wrong).alias(name) for name, wrong in checks.items()))
    return counts.select(
        F.inline(
            F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failures")) for n in checks))
        )
    )
