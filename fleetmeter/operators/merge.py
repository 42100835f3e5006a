"""MERGE as DataFrame joins, and its write path for partitioned tables.

Semantics kept from MERGE: NULL keys never match; a matched row takes the source's
value even when that is NULL; more than one source row for a key is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.functions.relational import any_null, same_key
from fleetmeter.session import as_of_column, scratch_scope, sized_shuffles, spill_to_table
from fleetmeter.sources import keyfilters, tables

Updates = Mapping[str, str | Column]


def _one_row_per_key(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The source rows with a full key; fails at run time when a key comes twice.

    The check is an aggregate with partial combine. It runs with the join, whenever a
    merged column is read.
    """
    rest = [c for c in source.columns if c not in on]
    message = F.concat(
        F.lit("merge source has several rows for key "), F.to_json(F.struct(*on))
    )
    counted = (
        source.filter(~any_null(on))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(F.struct(*rest, F.lit(1).alias("_present"))).alias("_row"))
    )
    checked = counted.filter(F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.lit(True)))
    return checked.select(*(c if c in on else F.col(f"_row.{c}").alias(c) for c in source.columns))


def _apply(target: DataFrame, source: DataFrame, on: Sequence[str], updates: Updates,
           eligible: str | None) -> DataFrame:
    """Left join with the updates on matched rows.

    A left join lets adaptive execution split a hot target key over several tasks.
    """
    condition = same_key("t", "s", on)
    if eligible is not None:
        condition = condition & F.expr(eligible)
    joined = target.alias("t").join(source.withColumn("_matched", F.lit(True)).alias("s"), condition, "left")

    def settle(c: str) -> Column:
        if c not in updates:
            return F.col(f"t.{c}")
        new = updates[c]
        new = F.expr(new) if isinstance(new, str) else new
        return F.when(F.col("s._matched"), new).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*(settle(c) for c in target.columns))


def merge_update(target: DataFrame, source: DataFrame, on: Sequence[str], updates: Updates,
                 eligible: str | None = None, stored: bool = False) -> DataFrame:
    """Update-only MERGE. ``eligible`` is a further condition on the target, as SQL over ``t``.

    A target that was just deduplicated on the key is already partitioned for the join, so it
    is joined whole. For a ``stored`` target, rows that cannot match (not eligible, NULL key)
    are split off in the scan and skip the shuffle.
    """
    source = _one_row_per_key(source, on)
    if not stored:
        return _apply(target, source, on, updates, eligible)
    target = target.alias("t")
    may_match = ~any_null(on)
    if eligible is not None:
        may_match = may_match & F.coalesce(F.expr(eligible), F.lit(False))
    return target.filter(~may_match).unionByName(_apply(target.filter(may_match), source, on, updates, None))


def upsert_merge(target: DataFrame, source: DataFrame, on: Sequence[str], updates: Updates,
                 stored: bool = False) -> DataFrame:
    """Matched rows take ``updates``; source rows without a match are inserted whole.

    Built from a left join and an anti join instead of one full outer join: both
    tolerate a hot key (split by adaptive execution on the left, collapsed by the
    distinct on the right), and NULL keys bypass the anti join. Unless the target is
    ``stored``, both inputs are written to the scratch folder first, so that their plans
    run once (this starts Spark jobs).
    """
    if not stored:
        target, source = spill_to_table(target, "merge-target"), spill_to_table(source, "merge-source")
    keyed = _one_row_per_key(source, on)
    keyless = source.filter(any_null(on))
    known = target.filter(~any_null(on)).select(*on).distinct()
    new = keyed.alias("s").join(known.alias("t"), same_key("s", "t", on), "left_anti")
    return (
        merge_update(target, source, on, updates, stored=True)
        .unionByName(new.select(*target.columns))
        .unionByName(keyless.select(*target.columns))
    )


def late_fill_left_join(target: DataFrame, source: DataFrame, on: Sequence[str], fill: Sequence[str],
                        eligible: str) -> DataFrame:
    """Keys and filled columns: the source's value where there is one, else the target's.

    Unlike MERGE, a NULL in the source leaves the target's value.
    """
    columns = [*on, *fill]
    condition = same_key("t", "s", on) & F.expr(eligible)
    joined = target.alias("t").join(source.select(*columns).alias("s"), condition, "left")
    return joined.select(
        *(F.col(f"t.{c}") for c in on), *(F.coalesce(f"s.{c}", f"t.{c}").alias(c) for c in fill)
    )


# ---------------------------------------------------------------- merge specifications

# Keys and updated columns of each table.
JOBS_KEY = ["job_id"]
JOBS_UPDATES = {
    c: f"s.{c}"
    for c in ("ended_at", "duration_hours", "exit_code", "cost_usd", "gpu_hours", "is_success", "_ingested_at")
}
INFERENCE_KEY = ["request_id"]
INFERENCE_UPDATES = {c: f"s.{c}" for c in ("status_code", "latency_ms", "cost_usd", "_ingested_at")}
NODE_METRICS_KEY = ["gpu_id", "timestamp"]
NODE_METRICS_UPDATES = {
    c: f"s.{c}" for c in ("gpu_util_pct", "memory_util_pct", "temp_celsius", "power_watts", "_ingested_at")
}


def completion_updates(as_of: datetime | None) -> dict[str, str | Column]:
    return {
        **{c: f"s.{c}" for c in ("ended_at", "duration_hours", "exit_code", "cost_usd")},
        "gpu_hours": "s.duration_hours * t.gpu_count",
        "is_success": "s.exit_code = 0",
        "_ingested_at": as_of_column(as_of),
    }


OPEN_JOB = "t.ended_at IS NULL"


def merge_completions(jobs: DataFrame, completions: DataFrame, as_of: datetime | None = None,
                      stored: bool = False) -> DataFrame:
    """Late completion events fill in jobs that have not ended; finished jobs stay as they are."""
    updates = {c: e for c, e in completion_updates(as_of).items() if c in jobs.columns}
    return merge_update(jobs, completions, JOBS_KEY, updates, OPEN_JOB, stored)


# ---------------------------------------------------------------- write path


def _check_updates(updates: Updates, partition_by: Sequence[str]) -> None:
    moved = set(updates) & set(partition_by)
    if moved:
        raise ValueError(f"a merge cannot update partition columns: {sorted(moved)}")


def upsert_table(spark: SparkSession, source: DataFrame, path: str, on: Sequence[str], updates: Updates,
                 partition_by: Sequence[str] = (), overwrite: bool = False,
                 fmt: str = tables.DEFAULT_FORMAT, key_filters: bool = False) -> DataFrame:
    """Upsert into a stored table and return a fresh read of it.

    The first run, or ``overwrite``, writes the whole table. Otherwise only partitions
    that hold a matched row or receive a source row are read in full and rewritten;
    finding them reads just the key and partition columns. With ``key_filters`` each call leaves
    a filter of the keys of every partition, and the next ones open key columns only where a
    filter does not rule all delivered keys out (see ``sources.keyfilters``).
    """
    _check_updates(updates, partition_by)
    if key_filters and partition_by and fmt == tables.DEFAULT_FORMAT:
        upsert_table(spark, source, path, on, updates, partition_by, overwrite, fmt)
        keyfilters.refresh(spark, path, on)
        return tables.scan_table(spark, path, fmt, tables.partition_types(source, partition_by))
    if fmt != "delta":
        tables.finish_replacement(spark, path)
    if overwrite or not tables.table_exists(spark, path, fmt):
        return tables.write_partitioned_overwrite(source, path, partition_by, fmt)
    if fmt == "delta":
        return _delta_merge(spark, source, path, on, updates, insert=True)
    target = tables.scan_table(spark, path, fmt, tables.partition_types(source, partition_by))
    with scratch_scope(spark), sized_shuffles(target, source):
        source = spill_to_table(source, "merge-source")
        if not partition_by:
            return tables.replace_table(upsert_merge(target, source, on, updates, stored=True), path, fmt)
        searched = keyfilters.narrowed(target, path, source, on)
        hit = searched.select(*dict.fromkeys([*on, *partition_by])).alias("t").join(
            source.select(*on).alias("s"), same_key("t", "s", on), "left_semi"
        )
        touched = hit.select(*partition_by).union(source.select(*partition_by)).distinct()
        affected = tables.in_partitions(target, spill_to_table(touched, "merge-touched"), partition_by)
        return tables.replace_partitions(
            upsert_merge(affected, source, on, updates, stored=True), path, partition_by, fmt
        )


def merge_completions_table(spark: SparkSession, path: str, completions: DataFrame,
                            as_of: datetime | None = None, partition_by: Sequence[str] = ("job_date",),
                            fmt: str = tables.DEFAULT_FORMAT, key_filters: bool = False) -> DataFrame | None:
    """Apply completions to the stored jobs table; does nothing while that table is absent."""
    if key_filters and partition_by and fmt == tables.DEFAULT_FORMAT:
        if merge_completions_table(spark, path, completions, as_of, partition_by, fmt) is None:
            return None
        keyfilters.refresh(spark, path, JOBS_KEY)
        return tables.scan_table(spark, path, fmt)
    if fmt != "delta":
        tables.finish_replacement(spark, path)
    if not tables.table_exists(spark, path, fmt):
        return None
    updates = completion_updates(as_of)
    _check_updates(updates, partition_by)
    if fmt == "delta":
        return _delta_merge(spark, completions, path, JOBS_KEY, updates, insert=False,
                            also=OPEN_JOB)
    jobs = tables.scan_table(spark, path, fmt)
    with scratch_scope(spark), sized_shuffles(jobs, completions):
        completions = spill_to_table(completions, "merge-source")
        if not partition_by:
            return tables.replace_table(merge_completions(jobs, completions, as_of, stored=True), path, fmt)
        searched = keyfilters.narrowed(jobs, path, completions, JOBS_KEY)
        open_jobs = searched.filter(F.col("ended_at").isNull()).select(*JOBS_KEY, *partition_by)
        touched = (
            open_jobs.alias("t")
            .join(completions.select(*JOBS_KEY).alias("s"), same_key("t", "s", JOBS_KEY), "left_semi")
            .select(*partition_by)
            .distinct()
        )
        affected = tables.in_partitions(jobs, spill_to_table(touched, "merge-touched"), partition_by)
        return tables.replace_partitions(
            merge_completions(affected, completions, as_of, stored=True), path, partition_by, fmt
        )


def _delta_merge(spark: SparkSession, source: DataFrame, path: str, on: Sequence[str], updates: Updates,
                 insert: bool, also: str | None = None) -> DataFrame:
    """Native MERGE, for sessions that have the Delta connector."""
    from delta.tables import DeltaTable

    condition = " AND ".join([f"t.`{c}` = s.`{c}`" for c in on] + ([also] if also else []))
    merge = DeltaTable.forPath(spark, path).alias("t").merge(source.alias("s"), condition)
    merge = merge.whenMatchedUpdate(set=dict(updates))
    if insert:
        merge = merge.whenNotMatchedInsertAll()
    merge.execute()
    return tables.scan_table(spark, path, "delta")


def upsert_jobs(spark: SparkSession, source: DataFrame, path: str, overwrite: bool = False,
                fmt: str = tables.DEFAULT_FORMAT, key_filters: bool = False) -> DataFrame:
    return upsert_table(spark, source, path, JOBS_KEY, JOBS_UPDATES, ["job_date"], overwrite, fmt, key_filters)


def upsert_inference(spark: SparkSession, source: DataFrame, path: str, overwrite: bool = False,
                     fmt: str = tables.DEFAULT_FORMAT, key_filters: bool = False) -> DataFrame:
    return upsert_table(spark, source, path, INFERENCE_KEY, INFERENCE_UPDATES, ["log_date"], overwrite, fmt, key_filters)


def upsert_node_metrics(spark: SparkSession, source: DataFrame, path: str, overwrite: bool = False,
                        fmt: str = tables.DEFAULT_FORMAT, key_filters: bool = False) -> DataFrame:
    return upsert_table(spark, source, path, NODE_METRICS_KEY, NODE_METRICS_UPDATES, ["metric_date"], overwrite, fmt, key_filters)
