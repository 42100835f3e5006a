"""Registered queries: every operator over the given tables, whole.

Outputs carry zone-free timestamps, since the session runs in UTC and the other engine
has no zoned counterpart in its results.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as X
from fleetmeter import session
from fleetmeter.functions import scalars as S
from fleetmeter.operators import dedup, enrich, filters, maintenance, merge, quality
from fleetmeter.plans import batch, incremental, marts, reads, staging
from fleetmeter.sources import files, messages, tables
from fleetmeter.streaming import health, ingest

AS_OF = datetime(2024, 2, 1)
CAPACITY_AS_OF = datetime(2024, 1, 5)
SLO_AS_OF = datetime(2024, 1, 20, 12)
FRESHNESS_AS_OF = datetime(2024, 1, 31)
COST_DATE = date(2024, 1, 20)
UTILIZATION_DATE = date(2024, 1, 2)
TREND_MODEL = "llama-3-70b-instruct"

Query = Callable[[SparkSession, str], DataFrame]


def zone_free(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        )
    )


class Inputs:
    """Lazily derived inputs and stages of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        session.prepare(self.spark, session.input_bytes(df))
        return df

    def derive(self, sql: str, **inputs: DataFrame) -> DataFrame:
        """Run a fixture query with its table names bound to DataFrames."""
        for name in inputs:
            sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
        return self.spark.sql(sql, **inputs)

    # raw
    def jobs_start(self): return self.derive(X.jobs_start(X.SPARK), orders=self.table("orders"))
    def jobs_completion(self): return self.derive(X.jobs_completion(X.SPARK), orders=self.table("orders"))
    def inference(self): return self.derive(X.inference(X.SPARK), events=self.table("events"))
    def node_metrics(self): return self.derive(X.node_metrics(X.SPARK), lineitem=self.table("lineitem"))
    def jobs_bronze(self): return self.derive(X.jobs_bronze(), jobs_start=self.jobs_start())
    def completions_bronze(self): return self.derive(X.completions_bronze(), jobs_completion=self.jobs_completion())
    def inference_bronze(self): return self.derive(X.inference_bronze(), inference=self.inference())

    # silver
    def silver_jobs(self): return enrich.silver_jobs(self.jobs_bronze(), AS_OF)
    def silver_inference(self): return enrich.silver_inference(self.inference_bronze(), AS_OF)
    def silver_node_metrics(self): return enrich.silver_node_metrics(self.node_metrics(), AS_OF)
    def completions(self): return dedup.dedup_completions(self.completions_bronze())
    def merged_jobs(self): return merge.merge_completions(self.silver_jobs(), self.completions(), AS_OF)

    # staging and gold
    def stg_jobs(self): return staging.stg_jobs(self.merged_jobs())
    def stg_inference(self): return staging.stg_inference(self.silver_inference())
    def stg_node_metrics(self): return staging.stg_node_metrics(self.silver_node_metrics())
    def job_costs(self): return staging.int_job_costs(self.stg_jobs(), AS_OF)
    def cost(self): return marts.cost_attribution(self.job_costs())
    def utilization(self): return marts.gpu_utilization_hourly(self.stg_node_metrics())
    def sla(self): return marts.job_performance_sla(self.stg_inference())

    # files and streams
    def scratch(self, label: str) -> str:
        return session.scratch_path(self.spark, label)

    def as_json(self, df: DataFrame) -> str:
        path = self.scratch("json")
        df.write.options(**messages.JSON_TIMESTAMPS, ignoreNullFields="false").json(path)
        return path

    def as_csv(self, df: DataFrame) -> str:
        path = self.scratch("csv")
        df.write.options(**messages.JSON_TIMESTAMPS, header="true").csv(path)
        return path

    def envelope(self) -> DataFrame:
        """The request log as queue messages."""
        logged = self.inference().withColumn("cache_hit", F.col("cache_hit").cast("boolean"))
        valued = logged.withColumn("value", messages.json_value(logged.columns))
        enveloped = self.derive(X.envelope(X.SPARK, "value"), inference=valued)
        return enveloped.withColumns(
            {
                "timestamp": F.col("timestamp").cast("timestamp"),
                "key": F.col("key").cast("binary"),
                "value": F.col("value").cast("binary"),
            }
        )

    def envelope_files(self) -> str:
        path = self.scratch("envelope")
        self.envelope().write.parquet(path)
        return path

    def drained(self, rows: DataFrame, partition_by: str) -> DataFrame:
        """Run a stream to the end of its input and read its table."""
        path = self.scratch("stream-table")
        query = ingest.stream_append_sink(rows, path, self.scratch("stream-checkpoint"), partition_by, drain=True)
        query.awaitTermination()
        return tables.scan_table(self.spark, path)

    def stream_table(self) -> DataFrame:
        """The ingested stream, stamped as if written when the queue received each message."""
        parsed = ingest.parse_stream_payload(self.envelope())
        return ingest.stream_date_hour_stamp(parsed).withColumn("_stream_ingested_at", F.col("kafka_timestamp"))


def _upsert_halves(df: DataFrame, ts: str, old_until: str, new_from: str, **changes) -> tuple[DataFrame, DataFrame]:
    """A stored part and an overlapping, changed delivery; together they cover the whole table."""
    def at(x: str):
        return F.lit(x).cast("timestamp_ntz")

    return df.filter(F.col(ts) < at(old_until)), df.filter(F.col(ts) >= at(new_from)).withColumns(changes)


def _upserted(i: Inputs, df: DataFrame, halves, upsert) -> DataFrame:
    path = i.scratch("upsert")
    stored, delivery = halves
    upsert(i.spark, stored, path)
    return upsert(i.spark, delivery, path).select(*df.columns).drop("_ingested_at")


def _jobs_halves(i: Inputs):
    df = i.merged_jobs()
    return df, _upsert_halves(
        df, "started_at", "2024-01-22 00:00:00", "2024-01-20 00:00:00",
        cost_usd=F.col("cost_usd") + 1, exit_code=F.lit(None).cast("int"), org_id=F.lit("org-new"),
    )


def _key_columns(i: Inputs) -> DataFrame:
    """Surrogate keys over strings, a date, an hour and NULLs."""
    df = i.stg_jobs()
    hour = F.date_trunc("hour", "started_at").cast("timestamp_ntz")
    return df.select(
        "job_id",
        S.surrogate_key(["job_id", "exit_code", "job_date", hour]).alias("local_key"),
        S.surrogate_key(["job_id", "exit_code", "job_date", hour], *S.KEY_FORMAT_PACKAGE).alias("package_key"),
    )


def _with_outcomes(df: DataFrame) -> DataFrame:
    return df.select("job_id", "exit_code", S.exited_cleanly(F.col("exit_code")).alias("is_success"))


def _all_reads_of(mart: Callable[[Inputs], DataFrame], read: Callable[..., DataFrame], **kw) -> Callable[[Inputs], DataFrame]:
    return lambda i: read(mart(i), **kw)


def _builders() -> dict[str, Callable[[Inputs], DataFrame]]:
    cost, util, sla = Inputs.cost, Inputs.utilization, Inputs.sla
    col = F.col
    return {
        # scans, sources, sinks
        "read_job_events": lambda i: files.read_job_events(i.spark, i.as_json(i.jobs_bronze())),
        "read_job_completions": lambda i: files.read_job_completions(i.spark, i.as_json(i.completions_bronze())),
        "read_inference_logs": lambda i: files.read_inference_logs(i.spark, i.as_json(i.inference_bronze())),
        "read_node_metrics": lambda i: files.read_node_metrics(i.spark, i.as_csv(i.node_metrics())),
        "read_malformed": _checked_lines,
        "scan_table": lambda i: tables.scan_table(i.spark, f"{i.sf_dir}/events.parquet"),
        "kafka_stream_source": lambda i: i.drained(
            ingest.file_stream_source(i.spark, i.envelope_files()), "partition"
        ).select("offset", "partition", "timestamp", col("key").cast("string").alias("key")),
        "write_partitioned_overwrite": lambda i: tables.write_partitioned_overwrite(
            i.silver_jobs().drop("_ingested_at"), i.scratch("overwrite"), ["job_date"]
        ),
        "stream_append_sink": lambda i: i.drained(
            ingest.stream_date_hour_stamp(
                ingest.parse_stream_payload(ingest.file_stream_source(i.spark, i.envelope_files()))
            ),
            "log_date",
        ).drop("_stream_ingested_at"),
        "to_kafka_records": lambda i: messages.to_kafka_records(i.jobs_start(), "job_id").select(
            "key", F.from_json("value", "job_id STRING, gpu_count INT, started_at TIMESTAMP, ended_at TIMESTAMP, "
                                        "duration_hours DOUBLE, cost_usd DOUBLE, is_late_arrival STRING").alias("v")
        ).select("key", "v.*"),
        # deduplication
        "dedup_jobs": lambda i: dedup.dedup_jobs(i.jobs_bronze()),
        "dedup_completions": Inputs.completions,
        "dedup_inference": lambda i: dedup.dedup_inference(i.inference_bronze()),
        "dedup_node_metrics": lambda i: dedup.dedup_node_metrics(i.node_metrics()),
        # projection and enrichment
        "price_lookup": lambda i: i.jobs_start().select(
            "job_id", S.price_per_gpu_hour(col("gpu_type")).alias("price_per_gpu_hour"),
            S.price_per_gpu_hour(col("model_arch")).alias("unknown_price"),
        ),
        "string_to_boolean": lambda i: i.inference().select(
            "request_id", S.lenient_boolean(col("cache_hit")).alias("cache_hit"),
            S.lenient_boolean(col("region")).alias("junk"),
        ),
        "job_success_flag": lambda i: _with_outcomes(i.jobs_start()),
        "request_success_flag": lambda i: i.inference().select(
            "request_id", S.request_succeeded(col("status_code")).alias("is_success")
        ),
        "gpu_hours": lambda i: i.jobs_start().select(
            "job_id", (col("duration_hours") * col("gpu_count")).alias("gpu_hours")
        ),
        "date_hour_parts": lambda i: enrich.date_hour_parts(
            i.inference().select("request_id", "timestamp"), "timestamp", "log_date", "log_hour"
        ),
        "ingest_stamp": lambda i: enrich.ingest_stamp(i.jobs_start().select("job_id"), AS_OF),
        "silver_jobs": lambda i: i.silver_jobs().drop("_ingested_at"),
        "silver_inference": lambda i: i.silver_inference().drop("_ingested_at"),
        "silver_node_metrics": lambda i: i.silver_node_metrics().drop("_ingested_at"),
        "stg_jobs": lambda i: i.stg_jobs().drop("_ingested_at"),
        "stg_inference": Inputs.stg_inference,
        "stg_node_metrics": Inputs.stg_node_metrics,
        "billable_hours": lambda i: i.job_costs().select("job_id", "billable_hours"),
        "job_cost": lambda i: i.job_costs().select("job_id", "cost_usd"),
        "job_status": lambda i: i.job_costs().select("job_id", "job_status"),
        "gpu_tier": lambda i: i.node_metrics().select("gpu_type", S.gpu_tier(col("gpu_type")).alias("gpu_tier")),
        "int_job_costs": Inputs.job_costs,
        "slo_breach_flag": lambda i: i.inference().select(
            "request_id", S.slo_breached(col("model_id"), col("latency_ms")).alias("breached")
        ),
        "model_size_tier": lambda i: i.inference().select(
            "request_id", S.model_size_tier(col("model_id")).alias("model_size_tier")
        ),
        "surrogate_key": _key_columns,
        "utilization_rates": lambda i: util(i).select(
            "hour_bucket", "gpu_type", "rack_id", "hour_of_day", "day_of_week", "high_util_rate", "idle_rate"
        ),
        "capacity_pressure": lambda i: i.node_metrics().select(
            "gpu_util_pct", S.capacity_pressure(col("gpu_util_pct")).alias("pressure"),
            S.capacity_pressure(F.nullif(col("gpu_util_pct"), F.lit(2.0))).alias("pressure_or_null"),
        ),
        "compliance_rate": lambda i: sla(i).groupBy("model_id").agg(
            F.count_if("slo_p99_breached").alias("breaches"), F.count(F.lit(1)).alias("days")
        ).withColumn("compliance_rate", S.compliance_rate(col("breaches"), col("days"))),
        "filter_gold_jobs": lambda i: filters.with_job_date(
            i.silver_jobs().select("job_id", F.when(col("exit_code") != 1, col("job_date")).alias("job_date"))
        ),
        "filter_successful_requests": lambda i: filters.successful_requests(i.stg_inference()).select(
            "request_id", "is_success"
        ),
        "date_range_filter": lambda i: filters.date_range_filter(i.silver_jobs(), "job_date", 3, COST_DATE).select(
            "job_id", "job_date"
        ),
        "rolling_days_filter": lambda i: filters.rolling_days_filter(i.silver_jobs(), "job_date", 7, AS_OF).select(
            "job_id", "job_date"
        ),
        "optional_equality_filters": lambda i: filters.optional_equality_filters(
            i.inference(), region="us-east-1", model_id=TREND_MODEL, org_id=None
        ).select("request_id", "region", "model_id"),
        # joins and merges
        "merge_completions": lambda i: i.merged_jobs().drop("_ingested_at"),
        "upsert_merge": lambda i: (lambda df, h: merge.upsert_merge(*h, merge.JOBS_KEY, merge.JOBS_UPDATES).drop(
            "_ingested_at"))(*_jobs_halves(i)),
        "upsert_jobs": lambda i: (lambda df, h: _upserted(i, df, h, merge.upsert_jobs))(*_jobs_halves(i)),
        "upsert_key_filters": lambda i: (lambda df, h: _upserted(i, df, h, partial(merge.upsert_jobs, key_filters=True)))(
            *_jobs_halves(i)),
        "upsert_inference": lambda i: (lambda df: _upserted(
            i, df,
            _upsert_halves(df, "timestamp", "2024-01-20 00:00:00", "2024-01-15 00:00:00",
                           latency_ms=col("latency_ms") + 1, region=F.lit("new")),
            merge.upsert_inference))(i.silver_inference()),
        "upsert_node_metrics": lambda i: (lambda df: _upserted(
            i, df,
            _upsert_halves(df, "timestamp", "2024-01-03 00:00:00", "2024-01-02 00:00:00",
                           gpu_util_pct=col("gpu_util_pct") / 2, rack_id=F.lit("new")),
            merge.upsert_node_metrics))(i.silver_node_metrics()),
        "late_fill_left_join": lambda i: merge.late_fill_left_join(
            dedup.dedup_jobs(i.jobs_bronze()), i.completions(), ["job_id"], ["ended_at", "cost_usd", "exit_code"],
            merge.OPEN_JOB,
        ),
        # aggregations
        "cost_attribution": cost,
        "gpu_utilization_hourly": util,
        "job_performance_sla": sla,
        "cost_by_org": _all_reads_of(cost, reads.cost_by_org, query_date=COST_DATE, days=3),
        "cost_by_model": _all_reads_of(cost, reads.cost_by_model, query_date=COST_DATE),
        "capacity_summary": _all_reads_of(util, reads.capacity_summary, as_of=CAPACITY_AS_OF),
        "active_over_days": lambda i: reads.active_over_days(
            marts.gpu_utilization_hourly(i.stg_node_metrics(), sketches=True), as_of=CAPACITY_AS_OF),
        "dashboard_cost_summary": _all_reads_of(cost, reads.dashboard_cost_summary, as_of=AS_OF),
        "dashboard_slo_summary": _all_reads_of(sla, reads.dashboard_slo_summary, as_of=AS_OF),
        "stream_freshness": lambda i: health.stream_freshness(i.stream_table(), FRESHNESS_AS_OF),
        "consumer_lag": lambda i: health.consumer_lag(
            health.end_offsets(i.envelope()),
            health.committed_offsets(i.stream_table().filter(col("log_date") < F.lit(COST_DATE))), 3_000,
        ),
        # order, limit, set operations
        "stream_progress": _tracked,
        "order_cost_attribution": lambda i: marts.order_cost_attribution(cost(i)),
        "order_utilization": lambda i: marts.order_utilization(util(i)),
        "order_sla": lambda i: marts.order_sla(sla(i)),
        "top_slo_breaches": _all_reads_of(sla, reads.top_slo_breaches, as_of=SLO_AS_OF),
        "union_all": lambda i: dedup.union_all(i.jobs_start(), i.jobs_start()).groupBy("job_id").agg(
            F.count(F.lit(1)).alias("copies")),
        "distinct_keys": lambda i: dedup.distinct_keys(i.jobs_bronze(), ["job_id"]),
        # reads
        "utilization_hourly": _all_reads_of(util, reads.utilization_hourly, query_date=UTILIZATION_DATE,
                                            gpu_type="A100-SXM4-80GB"),
        "sla_by_model": _all_reads_of(sla, reads.sla_by_model, query_date=COST_DATE),
        "sla_by_model_breaches": _all_reads_of(sla, reads.sla_by_model, query_date=COST_DATE, breaches_only=True),
        "sla_trends": _all_reads_of(sla, reads.sla_trends, model_id=TREND_MODEL, region="eu-west-1", as_of=AS_OF),
        "dashboard_summary": lambda i: reads.dashboard_summary(cost(i), sla(i), as_of=AS_OF),
        # streaming
        "parse_stream_payload": lambda i: ingest.parse_stream_payload(i.envelope()),
        "event_time_watermark": lambda i: i.drained(
            ingest.event_time_watermark(
                ingest.parse_stream_payload(ingest.file_stream_source(i.spark, i.envelope_files(), max_files=2))
            ).select("request_id", "timestamp", "kafka_partition"),
            "kafka_partition",
        ),
        "stream_date_hour_stamp": lambda i: ingest.stream_date_hour_stamp(
            ingest.parse_stream_payload(i.envelope())
        ).select("request_id", "log_date", "log_hour"),
        "inference_stream_ingest": lambda i: i.drained(
            ingest.inference_stream(ingest.file_stream_source(i.spark, i.envelope_files(), max_files=2)), "log_date"
        ).drop("_stream_ingested_at"),
        "unique_requests": _redelivered,
        "rate_limited_micro_batch": lambda i: _ingested(i, 1),
        "restart_exactly_once": lambda i: _ingested(i, 2),
        # data quality
        "expect_row_count_between": lambda i: quality.run_expectations(
            i.merged_jobs(), [quality.expect_row_count_between(500), quality.expect_row_count_between(None, 10)]),
        "expect_not_null": lambda i: quality.run_expectations(
            i.merged_jobs(), [quality.expect_not_null("job_id"), quality.expect_not_null("ended_at"),
                              quality.expect_not_null("ended_at", mostly=0.9)]),
        "expect_unique": lambda i: quality.run_expectations(
            i.jobs_bronze(), [quality.expect_unique("job_id"), quality.expect_unique("job_id", mostly=0.5)]),
        "expect_between": lambda i: quality.run_expectations(
            i.merged_jobs(), [quality.expect_between("gpu_count", 1, 512),
                              quality.expect_between("cost_usd", 10.0, mostly=0.99)]),
        "expect_in_set": lambda i: quality.run_expectations(
            i.merged_jobs(), [quality.expect_in_set("gpu_type", quality.KNOWN_GPU_TYPES, mostly=0.99),
                              quality.expect_in_set("framework", ["pytorch", "jax"], mostly=0.98)]),
        "expect_mean_between": lambda i: quality.run_expectations(
            i.silver_jobs(), [quality.expect_mean_between("gpu_count", 1.0, 500.0)]),
        "expect_median_between": lambda i: quality.run_expectations(
            i.silver_jobs(), [quality.expect_median_between("gpu_count", 1, 8),
                              quality.expect_median_between("duration_hours", 5, None)]),
        "silver_jobs_gate": lambda i: quality.silver_jobs_gate(i.silver_jobs()).withColumn(
            "observed", S.round_half_away(col("observed"), 6)),
        "test_unique": lambda i: quality.run_column_tests(
            {"jobs": i.jobs_bronze(), "inference": i.inference_bronze(), "cost_attribution": cost(i)},
            quality.tests_of_kind("unique")),
        "test_not_null": lambda i: quality.run_column_tests(
            {"jobs": i.jobs_bronze(), "inference": i.inference_bronze(), "cost_attribution": cost(i),
             "job_performance_sla": sla(i)},
            [*quality.tests_of_kind("not_null"), quality.not_null("jobs", "ended_at")]),
        "test_accepted_values": lambda i: quality.run_column_tests(
            {"jobs": i.jobs_bronze(), "inference": i.inference_bronze()},
            [*quality.tests_of_kind("accepted_values"),
             quality.accepted_values("inference", "status_code", [200, 429])]),
        "test_expression": lambda i: quality.run_column_tests(
            {"cost_attribution": cost(i), "gpu_utilization_hourly": util(i), "job_performance_sla": sla(i)},
            quality.tests_of_kind("expression")),
        "test_positive_costs": lambda i: quality.negative_costs(
            # A flat credit per group, so that there are faults to find.
            cost(i).withColumn("total_cost_usd", S.round_half_away(col("total_cost_usd") - 500.0, 4))),
        "sanity_jobs": lambda i: quality.sanity_jobs(
            i.merged_jobs().withColumn("gpu_count", col("gpu_count") - F.when(col("exit_code") == 1, 1).otherwise(0))),
        "promote_if_passed": _promoted,
        "promote_rejected": _rejected,
        "upsert_string_partitions": _upserted_by_text,
        # stored gold and maintenance
        "materialize_gold": lambda i: _together(_gold(i)),
        "refresh_gold": _refreshed,
        "optimize_tables": _optimized,
        "compact_zorder": lambda i: maintenance.compact_table(
            i.spark,
            _stored(i, i.silver_inference().drop("_ingested_at"), ["log_date"]),
            ["model_id", "org_id", "log_date"], ["log_date"],
        ),
    }


def _checked_lines(i: Inputs) -> DataFrame:
    """Both outputs of one parse of lines of which some are broken."""
    path = i.scratch("lines")
    i.derive(X.job_lines(X.SPARK), jobs_start=i.jobs_start()).select("line").write.text(path)
    checked = files.read_checked(i.spark, path, files.JOB_EVENTS)
    rows = files.readable(checked, files.JOB_EVENTS).select("job_id", "gpu_count")
    aside = files.malformed(checked, files.JOB_EVENTS).select("text", "kept")
    return rows.unionByName(aside, allowMissingColumns=True)


def _stored_silver(i: Inputs, jobs: DataFrame | None = None) -> str:
    root = i.scratch("silver")
    session.at_once(i.spark, *(
        partial(tables.write_partitioned_overwrite, df, f"{root}/{name}", [day]) for df, name, day in (
            (i.merged_jobs() if jobs is None else jobs, "jobs", "job_date"),
            (i.silver_inference(), "inference", "log_date"),
            (i.silver_node_metrics(), "node_metrics", "metric_date"),
        )))
    return root


def _gold(i: Inputs) -> dict[str, DataFrame]:
    return batch.materialize_gold(i.spark, _stored_silver(i), i.scratch("gold"), AS_OF)


def _refreshed(i: Inputs) -> DataFrame:
    """Gold of jobs without completions, which then come in late."""
    silver, gold = _stored_silver(i, i.silver_jobs()), i.scratch("gold")
    incremental.refresh_gold(i.spark, silver, gold, AS_OF)
    merge.merge_completions_table(i.spark, f"{silver}/jobs", i.completions(), AS_OF)
    incremental.refresh_gold(i.spark, silver, gold, AS_OF)
    return _together(incremental.stored_gold(i.spark, gold))


def _promoted(i: Inputs) -> DataFrame:
    silver = _stored_silver(i)
    checks = quality.silver_jobs_gate(tables.scan_table(i.spark, f"{silver}/jobs"))
    return quality.promote_if_passed(
        checks, lambda: _together(batch.materialize_gold(i.spark, silver, i.scratch("gold"), AS_OF))
    )


def _optimized(i: Inputs) -> DataFrame:
    silver, gold = _stored_silver(i), i.scratch("gold")
    batch.materialize_gold(i.spark, silver, gold, AS_OF)
    return _together(maintenance.optimize_tables(i.spark, silver, gold))


def _together(stored: dict[str, DataFrame]) -> DataFrame:
    """All tables under one another, each row with its table's name."""
    named = [df.drop("_ingested_at").withColumn("table_name", F.lit(name)) for name, df in stored.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def _rejected(i: Inputs) -> DataFrame:
    """Failed jobs lose their org: the gate must hold gold back."""
    jobs = i.silver_jobs().withColumn("org_id", F.when(F.col("exit_code") == 1, None).otherwise(F.col("org_id")))
    checks = quality.silver_jobs_gate(jobs)
    promoted = quality.promote_if_passed(checks, lambda: True)
    return checks.filter("NOT success").select("expectation", "column_name", "failing", F.lit(bool(promoted)).alias("promoted"))


def _upserted_by_text(i: Inputs) -> DataFrame:
    """A table whose string partitions look like numbers ('01' to '31')."""
    day = F.dayofmonth("job_date")
    jobs = i.silver_jobs().select("job_id", "exit_code", F.lpad(day.cast("string"), 2, "0").alias("p"), day.alias("day"))
    path = i.scratch("upsert")

    def deliver(rows: DataFrame) -> DataFrame:
        return merge.upsert_table(i.spark, rows.drop("day"), path, ["job_id"], {"exit_code": "s.exit_code"}, ["p"])

    deliver(jobs.filter("day <= 20"))
    return deliver(jobs.filter("day >= 15").withColumn("exit_code", F.col("exit_code") + 1))


def _ingested(i: Inputs, starts: int) -> DataFrame:
    """Ingest file by file, starting the query ``starts`` times on one checkpoint."""
    source, path, checkpoint = i.envelope_files(), i.scratch("stream-table"), i.scratch("stream-checkpoint")
    for _ in range(starts):
        stream = ingest.file_stream_source(i.spark, source, max_files=1)
        ingest.inference_stream_ingest(stream, path, checkpoint, drain=True).awaitTermination()
    return tables.scan_table(i.spark, path).drop("_stream_ingested_at")


def _redelivered(i: Inputs) -> DataFrame:
    """Every message comes a second time, further on in its partition, in later files."""
    source = i.scratch("envelope")
    i.envelope().write.parquet(source)
    i.envelope().withColumn("offset", F.col("offset") + 2**40).write.mode("append").parquet(source)
    stream = ingest.file_stream_source(i.spark, source, max_files=4)
    return i.drained(ingest.unique_requests(stream, within="1 day"), "log_date").drop("kafka_offset", "_stream_ingested_at")


def _tracked(i: Inputs) -> DataFrame:
    """The progress table after two runs, with files added in between."""
    table, progress, checkpoint = i.scratch("stream-table"), i.scratch("progress"), i.scratch("progress-checkpoint")
    rows = i.stream_table()
    for part in (F.col("kafka_offset") % 2 == 0, F.col("kafka_offset") % 2 == 1):
        rows.filter(part).write.mode("append").partitionBy("log_date").parquet(table)
        health.track_progress(i.spark, table, progress, checkpoint).awaitTermination()
    return health.read_progress(i.spark, progress)


def _stored(i: Inputs, df: DataFrame, partition_by: list[str]) -> str:
    path = i.scratch("table")
    tables.write_partitioned_overwrite(df, path, partition_by)
    return path


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.prepare(spark)
            return zone_free(build(Inputs(spark, sf_dir)))

        return run

    return {name: bind(build) for name, build in _builders().items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["cost_by_org"](spark, sf_dir)
