from datetime import date, datetime

import pytest
from conftest import NOW
from pyspark.sql import functions as F
from fleetmeter.operators import filters
from fleetmeter.plans import marts, reads, staging

COST_ROW = (
    "job_date date, org_id string, user_id string, model_arch string, gpu_tier string, gpu_type string, "
    "framework string, job_status string, cost_usd double, gpu_hours double, billable_hours double"
)


def cost_rows(spark, rows):
    return spark.createDataFrame(
        [(d, "o", "u", "m", "flagship", "H100", "jax", s, c, g, b) for d, s, c, g, b in rows], COST_ROW)


def test_cost_attribution_counts_rates_and_filtered_means(spark):
    d = date(2024, 1, 1)
    rows = [(d, "succeeded", 10.0, 4.0, 2.0), (d, "succeeded", 5.5, 2.0, 1.0), (d, "oom_killed", 3.0, 1.0, 7.0),
            (d, "platform_error", 0.0, 9.0, 0.0), (d, "failed", None, 1.0, 1.0), (d, "running", 1.0, None, 3.0),
            (None, "failed", 1.0, 1.0, 1.0)]
    r = marts.cost_attribution(cost_rows(spark, rows)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.total_jobs, r.succeeded_jobs, r.oom_jobs, r.failed_jobs, r.running_jobs) == (6, 2, 1, 1, 1)
    assert (r.total_cost_usd, r.total_gpu_hours) == (19.5, 17.0)
    assert (r.avg_cost_per_success_usd, r.avg_duration_hours, r.max_duration_hours) == (7.75, 1.5, 7.0)
    assert (r.oom_rate, r.success_rate) == (0.1667, 0.4)
    assert len(r.attribution_id) == 32


def test_only_running_jobs_have_no_success_rate(spark):
    r = marts.cost_attribution(cost_rows(spark, [(date(2024, 1, 1), "running", None, None, 3.0)])).first()
    assert r.success_rate is None and r.total_cost_usd is None and r.oom_rate == 0.0


REQUEST = ("log_date date, model_id string, region string, is_success boolean, cache_hit boolean, latency_ms double, "
           "total_tokens int, cost_usd double")


@pytest.mark.parametrize("method", ["exact"])
def test_sla_mart(spark, method):
    d = date(2024, 1, 1)
    rows = [(d, "m-70b", "r", True, i % 4 == 0, 100.0 * i, i, 0.5) for i in range(101)]
    rows += [(d, "m-70b", "r", False, False, 1e9, 1, 1.0), (d, "m-70b", "r", None, False, 1e9, 1, 1.0)]
    rows += [(d, "m", None, True, True, 5.0, None, None), (None, "m", "x", True, None, None, 1, 1.0)]
    got = {(r.model_id, r.region): r for r in marts.job_performance_sla(spark.createDataFrame(rows, REQUEST), method).collect()}
    assert len(got) == 3
    big = got["m-70b", "r"]
    assert (big.total_requests, big.cache_hit_requests, big.cache_hit_rate) == (101, 26, 0.2574)
    assert (big.p50_latency_ms, big.p95_latency_ms, big.p99_latency_ms, big.max_latency_ms) == (5000.0, 9500.0, 9900.0, 10000.0)
    assert big.slo_p99_breached is True and big.model_size_tier == "large"
    assert (big.total_tokens, big.avg_tokens_per_request, big.total_cost_usd) == (5050, 50.0, 50.5)
    cached = got["m", None]
    assert cached.p50_latency_ms == 5.0 and cached.p50_latency_ms_non_cached is None
    assert cached.slo_p99_breached is False
    unknown = got["m", "x"]
    assert unknown.p99_latency_ms is None and unknown.slo_p99_breached is None and unknown.cache_hit_requests == 0


METRIC = ("hour_bucket timestamp, metric_date date, gpu_type string, gpu_tier string, rack_id string, node_id string, "
          "gpu_id string, gpu_util_pct double, memory_util_pct double, temp_celsius double, power_watts double")


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_utilization_mart(spark, method):
    hour = datetime(2024, 1, 7, 13)
    rows = [(hour, hour.date(), "H100", "flagship", rack, f"n{i % 2}", f"g{i % 4}", float(u), 50.0, 80.0 + i, 500.0)
            for rack in ("a", None) for i, u in enumerate((5, 9, 10, 50, 90, 91, 95, 100))]
    rows.append((hour, hour.date(), "H100", "flagship", "empty", None, None, None, None, None, None))
    got = {r.rack_id: r for r in marts.gpu_utilization_hourly(spark.createDataFrame(rows, METRIC), method).collect()}
    assert set(got) == {"a", None, "empty"}
    for rack in ("a", None):
        r = got[rack]
        assert (r.hour_of_day, r.day_of_week) == (13, 0)
        assert (r.active_nodes, r.active_gpus) == (2, 4)
        assert (r.high_util_gpu_count, r.idle_gpu_count, r.thermal_warning_count) == (3, 2, 2)
        assert (r.high_util_rate, r.idle_rate) == (0.75, 0.5)
        assert (r.avg_gpu_util_pct, r.max_gpu_util_pct, r.total_power_kw) == (56.25, 100.0, 4.0)
        if method != "approx":
            assert (r.p50_gpu_util_pct, r.p95_gpu_util_pct) == (70.0, 98.25)
    assert got["empty"].active_gpus == 0 and got["empty"].high_util_rate is None
    assert got["empty"].p50_gpu_util_pct is None and got["empty"].avg_gpu_util_pct is None


def test_order_puts_nulls_last(spark):
    rows = [(date(2024, 1, d) if d else None, c, str(d)) for d, c in ((1, 5.0), (2, 1.0), (2, None), (2, 9.0), (None, 3.0))]
    df = spark.createDataFrame(rows, "job_date date, total_cost_usd double, attribution_id string")
    assert [(r.job_date and r.job_date.day, r.total_cost_usd) for r in marts.order_cost_attribution(df).collect()] == [
        (2, 9.0), (2, 1.0), (2, None), (1, 5.0), (None, 3.0)]


def test_order_utilization_and_sla(spark):
    util = spark.createDataFrame([(NOW.replace(hour=h), g, "r") for h, g in ((1, "b"), (3, "b"), (3, "a"))],
                                 "hour_bucket timestamp, gpu_type string, rack_id string")
    assert [(r.hour_bucket.hour, r.gpu_type) for r in marts.order_utilization(util).collect()] == [(3, "a"), (3, "b"), (1, "b")]
    sla = spark.createDataFrame([(date(2024, 1, d), n, "m", "r") for d, n in ((1, 9), (2, 1), (2, 7))],
                                "log_date date, total_requests bigint, model_id string, region string")
    assert [(r.log_date.day, r.total_requests) for r in marts.order_sla(sla).collect()] == [(2, 7), (2, 1), (1, 9)]


GOLD = ("job_date date, org_id string, model_arch string, gpu_tier string, total_cost_usd double, total_gpu_hours double, "
        "total_jobs bigint, succeeded_jobs bigint, oom_jobs bigint, oom_rate double, success_rate double, "
        "avg_cost_per_success_usd double, avg_duration_hours double")


@pytest.fixture
def gold_cost(spark):
    rows = [(date(2024, 1, d), o, "llm", "flagship", c, 1.5, 2, 1, 1, 0.5, s, c, 2.0)
            for d, o, c, s in ((12, "a", 1.0, 0.1), (13, "a", 2.0, None), (14, "b", 4.0, 0.2), (14, "a", 8.0, 0.4))]
    return spark.createDataFrame(rows, GOLD)


def test_cost_by_org_defaults_to_yesterday(gold_cost):
    got = reads.cost_by_org(gold_cost, as_of=NOW).collect()
    assert [(r.org_id, r.total_cost_usd, r.avg_success_rate) for r in got] == [("a", 8.0, 0.4), ("b", 4.0, 0.2)]
    wide = reads.cost_by_org(gold_cost, date(2024, 1, 14), days=3).collect()
    assert [(r.org_id, r.total_cost_usd, r.total_jobs, r.avg_success_rate) for r in wide] == [
        ("a", 11.0, 6, 0.25), ("b", 4.0, 2, 0.2)]


def test_cost_by_model_covers_a_week(gold_cost):
    got = reads.cost_by_model(gold_cost, as_of=NOW).collect()
    assert [(r.model_arch, r.total_cost_usd, r.avg_cost_per_job) for r in got] == [("llm", 15.0, 3.75)]


@pytest.mark.parametrize("call", [
    lambda df: reads.cost_by_org(df, days=0), lambda df: reads.cost_by_model(df, days=91),
    lambda df: reads.capacity_summary(df, days=31), lambda df: reads.sla_trends(df, "m", days=91),
])
def test_day_bounds(gold_cost, call):
    with pytest.raises(ValueError, match="days"):
        call(gold_cost)


SLA = ("log_date date, model_id string, region string, model_size_tier string, total_requests bigint, cache_hit_rate double, "
       "p50_latency_ms double, p95_latency_ms double, p99_latency_ms double, p99_latency_ms_non_cached double, "
       "slo_p99_breached boolean, total_cost_usd double")


@pytest.fixture
def gold_sla(spark):
    rows = [(date(2024, 1, d), m, "r", "small", 1, 0.5, 1.0, 2.0, p, p, b, 1.0)
            for d, m, p, b in ((15, "x", 30.04, True), (15, "y", 40.0, True), (15, "z", None, None), (15, "w", 90.0, False),
                               (14, "x", 10.0, True), (1, "x", 10.0, False))]
    return spark.createDataFrame(rows, SLA)


def test_sla_reads(gold_sla):
    day = date(2024, 1, 15)
    assert [r.model_id for r in reads.sla_by_model(gold_sla, day).collect()] == ["y", "x", "w", "z"]
    assert [(r.model_id, r.p99_ms) for r in reads.sla_by_model(gold_sla, day, breaches_only=True).collect()] == [
        ("y", 40.0), ("x", 30.0)]
    assert [r.log_date.day for r in reads.sla_trends(gold_sla, "x", as_of=NOW).collect()] == [1, 14, 15]
    assert reads.sla_trends(gold_sla, "x", region="'; drop", as_of=NOW).count() == 0
    assert [r.model_id for r in reads.top_slo_breaches(gold_sla, as_of=NOW).collect()] == ["y", "x"]
    assert reads.top_slo_breaches(gold_sla, 1, NOW).count() == 1


def test_dashboard(gold_cost, gold_sla, spark):
    nested = reads.dashboard_summary(gold_cost, gold_sla, as_of=NOW, nested=True).first()
    assert nested.period == "last_7_days"
    assert nested.cost.asDict() == {"total_usd": 15.0, "total_gpu_hours": 6.0}
    assert nested.jobs.asDict() == {"total": 8, "avg_success_rate": 0.2333, "avg_oom_rate": 0.5}
    assert nested.slo.asDict() == {"breach_count": 3, "total_model_days": 5, "compliance_rate": 0.4}
    empty = reads.dashboard_summary(gold_cost.limit(0), gold_sla.limit(0), as_of=NOW).first()
    assert (empty.total_usd, empty.breach_count, empty.compliance_rate) == (None, 0, 1.0)


def test_filters(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (7, 8, 14, 15, 16)], "d date")

    def days(x):
        return [r.d.day for r in x.collect()]

    assert days(filters.rolling_days_filter(df, "d", 7, NOW)) == [8, 14, 15, 16]
    assert days(filters.date_range_filter(df, "d", 7, as_of=NOW)) == [8, 14]
    assert days(filters.on_date_filter(df, "d", as_of=NOW)) == [14]
    assert days(filters.optional_equality_filters(df, d=None)) == [7, 8, 14, 15, 16]


def test_date_filters_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 20)], "job_date date, x int").write.partitionBy(
        "job_date").parquet(path)
    df = filters.date_range_filter(spark.read.parquet(path), "job_date", 3, date(2024, 1, 9))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(job_date" in plan and df.count() == 3


def test_top_n_is_not_a_full_sort(gold_sla):
    assert "TakeOrderedAndProject" in reads.top_slo_breaches(gold_sla, as_of=NOW)._jdf.queryExecution().executedPlan().toString()


def test_sketches_count_over_days_and_leave_the_rest_alone(spark):
    readings = spark.range(60_000).select(
        (F.lit(NOW).cast("timestamp") - F.make_dt_interval(hours=(F.col("id") % 48).cast("int"))).alias("timestamp"),
        F.concat(F.lit("n"), F.col("id") % 700).alias("node_id"), F.concat(F.lit("g"), F.col("id") % 20_011).alias("gpu_id"),
        F.lit("r").alias("rack_id"), F.lit("A10G").alias("gpu_type"),
        *(F.lit(1.0).alias(c) for c in ("gpu_util_pct", "memory_util_pct", "temp_celsius", "power_watts")))
    staged = staging.stg_node_metrics(readings)
    plain, sketched = marts.gpu_utilization_hourly(staged), marts.gpu_utilization_hourly(staged, sketches=True)
    assert sketched.columns == [*plain.columns, *marts.SKETCHES]
    assert sketched.select(plain.columns).exceptAll(plain).count() == 0
    row = reads.active_over_days(sketched, 7, NOW).first()
    # Three standard errors.
    assert abs(row.active_nodes - 700) <= 0.05 * 700 and abs(row.active_gpus - 20_011) <= 0.05 * 20_011
    assert reads.active_over_days(sketched.limit(0), 7, NOW).count() == 0
