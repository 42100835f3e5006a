import glob
import threading
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from checks.registry import AS_OF, Inputs
from conftest import DATA
from fleetmeter import session
from fleetmeter.operators import maintenance
from fleetmeter.plans import batch, marts, reads
from fleetmeter.sources import messages, tables


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    i = Inputs(spark, DATA)
    options = {**messages.JSON_TIMESTAMPS, "ignoreNullFields": "false"}
    i.jobs_bronze().write.options(**options).json(f"{root}/job_events")
    i.completions_bronze().write.options(**options).json(f"{root}/job_completions")
    i.inference_bronze().write.options(**options).json(f"{root}/inference_logs")
    i.node_metrics().write.options(**messages.JSON_TIMESTAMPS, header=True).csv(f"{root}/node_metrics")
    return str(root)


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = (x.select(*(F.col(c).cast("string") for c in columns)) for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_end_to_end(spark, bronze, tmp_path):
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    result = batch.run_batch(spark, bronze, silver, gold, AS_OF)
    assert result.promoted and result.checks.filter("NOT success").count() == 0
    i = Inputs(spark, DATA)
    assert result.counts == {
        "jobs": i.jobs_start().count(), "inference": i.inference().count(),
        "node_metrics": i.silver_node_metrics().count(),
    }
    failures = {(r.table_name, r.column_name): r.failures for r in result.gold_tests.collect() if r.failures}
    # Jobs on unknown GPUs have no price, and the silver test of the GPU type names them.
    assert set(failures) <= {("gpu_utilization_hourly", "high_util_rate"), ("cost_attribution", "total_cost_usd")}
    unknown = {r.column_name: r.failures for r in result.silver_tests.collect() if r.failures}
    assert set(unknown) == {"gpu_type"}

    cost = tables.scan_table(spark, f"{gold}/cost_attribution")
    assert same_rows(cost, i.cost())
    assert same_rows(tables.scan_table(spark, f"{gold}/job_performance_sla"), i.sla())
    assert same_rows(tables.scan_table(spark, f"{gold}/gpu_utilization_hourly"), i.utilization())
    assert reads.cost_by_org(cost, days=90, as_of=AS_OF).count() == 4
    assert spark.table("stg_jobs").count() == result.counts["jobs"]

    # A second run merges into what is there and changes nothing.
    again = batch.run_batch(spark, bronze, silver, gold, AS_OF, overwrite=False, optimize=False)
    assert again.promoted and same_rows(tables.scan_table(spark, f"{gold}/cost_attribution"), i.cost())


def test_batch_by_changed_dates(spark, bronze, tmp_path):
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    result = batch.run_batch(spark, bronze, silver, gold, AS_OF, optimize=False, incremental=True)
    assert result.promoted and spark.table("stg_jobs").count() == result.counts["jobs"]
    assert same_rows(tables.scan_table(spark, f"{gold}/cost_attribution"), Inputs(spark, DATA).cost())


def test_failed_gate_leaves_gold_alone(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(batch.quality, "SILVER_JOBS_SUITE", [batch.quality.expect_row_count_between(10**9)])
    result = batch.run_batch(spark, bronze, f"{tmp_path}/silver", f"{tmp_path}/gold", AS_OF)
    assert not result.promoted and result.gold_tests is None
    assert not tables.table_exists(spark, f"{tmp_path}/gold/cost_attribution")


def test_compaction_clusters_and_keeps_content(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20000).select(
        F.concat(F.lit("org-"), F.col("id") % 50).alias("org"), ((F.col("id") * 7919) % 1000).alias("n"),
        (F.col("id") % 2).cast("int").alias("day"), F.when(F.col("id") % 11 > 0, F.col("id") % 9).alias("maybe"))
    df.repartition(30).write.partitionBy("day").parquet(path)
    before = df.cache()
    got = maintenance.compact_table(spark, path, ["org", "n", "maybe", "day"], ["day"], files=8)
    assert same_rows(got, before)
    assert len(glob.glob(path + "/*/*.parquet")) <= 8 + 2
    # Clustering narrows each file's range in both columns.
    spans = got.groupBy(F.input_file_name()).agg((F.max("n") - F.min("n")).alias("s")).agg(F.avg("s")).first()[0]
    assert spans < 990


def test_one_hot_value_still_spreads_over_files(spark):
    df = spark.range(40000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").alias("x"))
    sizes = [r["count"] for r in maintenance.compact_zorder(df, ["k"], files=8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 40000 / 8


def test_partition_columns_stay_out_of_the_cluster_key():
    for layout in (maintenance.SILVER_LAYOUT, maintenance.GOLD_LAYOUT):
        for cluster_by, partition_by in layout.values():
            assert set(partition_by) < set(cluster_by)
    assert len(maintenance.SILVER_LAYOUT) + len(maintenance.GOLD_LAYOUT) == 5


class FakeSession:
    """Settings only: the scratch folder is a static setting of a real session."""

    def __init__(self, master, **settings):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.settings = settings

    def get(self, key, default):
        return self.settings.get(key, default)


def test_scratch_follows_the_session_setting():
    shared = FakeSession("spark://host:1", **{"spark.checkpoint.dir": "hdfs://x/cp/"})
    assert session.scratch_path(shared, "a").startswith("hdfs://x/cp/fleetmeter/a-")
    assert session.scratch_path(shared, "a") != session.scratch_path(shared, "a")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(FakeSession("spark://host:1"), "a")
    assert "fleetmeter-" in session.scratch_path(FakeSession("local[2]"), "a")


def test_shuffle_partitions_only_rise(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.prepare(spark, 10)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        session.prepare(spark, 100 * session.SHUFFLE_TARGET_BYTES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "100"
        session.prepare(spark, 100 * 2**40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(100 * 2**40 // session.SHUFFLE_TARGET_BYTES)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sizing_of_a_step_ends_with_it(spark, tmp_path, monkeypatch):
    spark.range(10_000).write.parquet(path := str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "SHUFFLE_TARGET_BYTES", 1000)
    with session.sized_shuffles(spark.read.parquet(path)):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_of_a_step_is_deleted(spark):
    with session.scratch_scope(spark):
        path = session.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert tables.table_exists(spark, path)
    assert not tables.table_exists(spark, path)


def test_instants_are_converted_to_utc(spark):
    noon = datetime(2024, 1, 1, 12, tzinfo=timezone(timedelta(hours=2)))
    assert spark.range(1).select(session.as_of_column(noon).cast("string")).first()[0] == "2024-01-01 10:00:00"
    assert session.as_of_date(datetime(2024, 1, 1, 1, tzinfo=timezone(timedelta(hours=2)))) == date(2023, 12, 31)


def test_compaction_leaves_tidy_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "id % 2 AS p")
    df.filter("p = 0").coalesce(1).write.partitionBy("p").parquet(path)
    df.filter("p = 1").repartition(6).write.mode("append").partitionBy("p").parquet(path)
    tidy = glob.glob(path + "/p=0/*.parquet")
    got = maintenance.compact_table(spark, path, ["k", "id"], ["p"])
    assert glob.glob(path + "/p=0/*.parquet") == tidy and len(glob.glob(path + "/p=1/*.parquet")) == 1
    assert got.count() == 1000 and same_rows(got, df.withColumn("p", F.col("p").cast("int")))


def test_requests_may_come_from_the_stream_table(spark, bronze, tmp_path):
    i = Inputs(spark, DATA)
    streamed = i.stream_table()
    batch.build_silver(spark, bronze, f"{tmp_path}/a", AS_OF, requests=streamed)
    got = tables.scan_table(spark, f"{tmp_path}/a/inference")
    assert got.count() == streamed.select("request_id").distinct().count() and not [c for c in got.columns if c.startswith("kafka")]


def test_scans_read_only_the_columns_in_use(spark):
    i = Inputs(spark, DATA)
    plan = marts.cost_attribution(i.job_costs())._jdf.queryExecution().executedPlan().toString()
    unused = {"o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"} ^ set(i.table("orders").columns)
    assert unused and not any(c in plan for c in unused)


def test_gold_tables_are_stored_side_by_side(spark, monkeypatch):
    """Each of the three stores that need no other waits for the rest to begin."""
    inputs, together = Inputs(spark, DATA), threading.Barrier(3, timeout=60)
    views = {"stg_jobs": inputs.stg_jobs(), "stg_inference": inputs.stg_inference(), "stg_node_metrics": inputs.stg_node_metrics()}

    def store(df, path, *_):
        if not path.endswith("cost_attribution"):
            together.wait()
        return df

    monkeypatch.setattr(batch, "staging_views", lambda *_: views)
    monkeypatch.setattr(batch.tables, "write_partitioned_overwrite", store)
    gold = batch.materialize_gold(spark, "silver", "gold")
    assert list(gold) == ["int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla"]
