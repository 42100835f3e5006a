import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import COMPLETION_FIELDS, NOW, ago
from fleetmeter.operators import dedup, enrich, maintenance, merge
from fleetmeter.sources import tables


def silver(jobs):
    return enrich.silver_jobs(jobs.withColumn("dataset_size_gb", F.lit(1.0)), NOW)


def by_id(df):
    return {r.job_id: r for r in df.collect()}


def test_dedup_is_idempotent(sample_jobs):
    doubled = dedup.union_all(sample_jobs, sample_jobs)
    once = dedup.dedup_jobs(doubled)
    assert sorted(once.collect()) == sorted(sample_jobs.collect())
    assert dedup.distinct_keys(doubled, ["job_id"]).count() == once.count()


def test_dedup_winner_is_smallest_and_null_keys_are_one_group(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "z"), ("a", 1, "b"), (None, 5, "x"), (None, 4, "y")],
                               "k string, n int, s string")
    assert sorted(dedup.dedup(df, ["k"]).collect(), key=str) == [("a", 1, "b"), (None, 4, "y")]
    assert sorted(dedup.dedup(df, ["k"], ["s"]).collect(), key=str) == [("a", 2, None), (None, 5, "x")]
    assert dedup.dedup(df.select("k"), ["k"]).count() == 2


@pytest.mark.parametrize("stored", [False, True])
def test_completion_fills_only_open_jobs(spark, sample_jobs, completions, stored):
    late = completions.unionByName(spark.createDataFrame([("train-a", NOW, 9.0, 1, 999.0)], COMPLETION_FIELDS))
    merged = by_id(merge.merge_completions(silver(sample_jobs), late, NOW, stored))
    assert len(merged) == 6
    filled = merged["train-b"]
    assert (filled.ended_at, filled.cost_usd, filled.exit_code) == (ago(hours=1), 30.0, 0)
    assert (filled.gpu_hours, filled.is_success) == (10.0, True)
    assert merged["train-a"].cost_usd == 357.0 and merged["train-a"].ended_at == ago(hours=9, minutes=30)


@pytest.mark.parametrize("stored", [False, True])
def test_matched_null_overwrites_and_null_keys_never_match(spark, stored):
    schema = "k string, v int, w int"
    target = spark.createDataFrame([("a", 1, 1), (None, 2, 2), ("c", 3, 3)], schema)
    source = spark.createDataFrame([("a", None, 9), (None, 8, 8), (None, 8, 8), ("d", 4, 4)], schema)
    got = merge.upsert_merge(target, source, ["k"], {"v": "s.v"}, stored)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", None, 1), (None, 2, 2), ("c", 3, 3), ("d", 4, 4), (None, 8, 8), (None, 8, 8)], key=str)


def test_late_fill_keeps_target_where_source_is_null(spark, sample_jobs):
    partial = spark.createDataFrame([("train-b", NOW, None, None, 36.0), ("train-a", NOW, 1.0, 1, 1.0)], COMPLETION_FIELDS)
    got = by_id(merge.late_fill_left_join(sample_jobs, partial, ["job_id"], ["ended_at", "cost_usd", "exit_code"],
                                          merge.OPEN_JOB))
    assert tuple(got["train-b"]) == ("train-b", NOW, 36.0, None)
    assert tuple(got["train-a"]) == ("train-a", ago(hours=9, minutes=30), 357.0, 0)


def test_repeated_source_key_is_an_error(spark, sample_jobs, completions):
    twice = completions.unionByName(completions.withColumn("cost_usd", F.lit(1.0)))
    with pytest.raises(PySparkException, match="several rows for key .*train-b"):
        merge.merge_completions(silver(sample_jobs), twice, NOW).collect()
    with pytest.raises(PySparkException, match="several rows for key"):
        merge.merge_completions(silver(sample_jobs), twice, NOW).agg(F.sum("cost_usd")).collect()
    # A reader of untouched columns needs no join, and still sees each job once.
    assert merge.merge_completions(silver(sample_jobs), twice, NOW).select("job_id").count() == 6


def test_hot_target_key_gets_every_update(spark):
    target = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.col("id").alias("n"), F.lit(0).alias("v"))
    source = spark.createDataFrame([("hot", -1, 7), ("new", -2, 8)], "k string, n bigint, v int")
    got = merge.upsert_merge(target, source, ["k"], {"v": "s.v"})
    assert got.count() == 5001
    assert got.filter("k = 'hot' AND v = 7").count() == 4000


def mtimes(path):
    return {p: {f: os.path.getmtime(f) for f in glob.glob(p + "/*.parquet")} for p in glob.glob(path + "/*=*")}


def test_stored_upsert_touches_only_affected_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "request_id string, status_code int, latency_ms double, cost_usd double, _ingested_at timestamp, log_date date"
    day = lambda d: NOW.replace(day=d).date()
    rows = [(f"r{i}", 200, 1.0 * i, 0.1, NOW, day(1 + i % 3)) for i in range(30)]
    first = merge.upsert_inference(spark, spark.createDataFrame(rows, schema), path)
    assert first.count() == 30
    before = mtimes(path)
    delivery = [("r0", 500, 99.0, None, NOW, day(1)), ("new", 200, 5.0, 0.2, NOW, day(9))]
    got = merge.upsert_inference(spark, spark.createDataFrame(delivery, schema), path)
    after = mtimes(path)
    changed = {p.rsplit("=", 1)[1] for p in after if before.get(p) != after[p]}
    assert changed == {"2024-01-01", "2024-01-09"}
    assert got.count() == 31
    row = got.filter("request_id = 'r0'").first()
    assert (row.status_code, row.latency_ms, row.cost_usd) == (500, 99.0, None)
    assert got.filter("request_id = 'new'").first().log_date == day(9)
    again = merge.upsert_inference(spark, spark.createDataFrame(delivery, schema), path)
    assert again.count() == 31
    replaced = merge.upsert_inference(spark, spark.createDataFrame(delivery, schema), path, overwrite=True)
    assert replaced.count() == 2


def test_stored_upsert_finds_a_match_in_another_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "job_id string, v int, job_date string"
    merge.upsert_table(spark, spark.createDataFrame([("a", 1, "x"), ("b", 1, None)], schema), path, ["job_id"],
                       {"v": "s.v"}, ["job_date"])
    got = merge.upsert_table(spark, spark.createDataFrame([("a", 2, "y"), ("b", 3, "y")], schema), path, ["job_id"],
                             {"v": "s.v"}, ["job_date"])
    assert sorted(map(tuple, got.select("job_id", "v", "job_date").collect())) == [("a", 2, "x"), ("b", 3, None)]


@pytest.mark.parametrize("values", [("01", "02", "10"), ("1e3", "1000", "1"), ("2024-01-01", "2024-1-1", "x"), ("true", None, "null")])
def test_string_partitions_keep_their_text(spark, tmp_path, values):
    path, schema = str(tmp_path / "t"), "k string, v int, p string"
    first = [(f"k{i}", 1, p) for i, p in enumerate(values)]
    merge.upsert_table(spark, spark.createDataFrame(first, schema), path, ["k"], {"v": "s.v"}, ["p"])
    folders = set(glob.glob(path + "/p=*"))
    got = merge.upsert_table(spark, spark.createDataFrame([("k0", 2, values[0]), ("new", 3, values[1])], schema), path, ["k"], {"v": "s.v"}, ["p"])
    expected = sorted([("k0", 2, values[0]), *first[1:], ("new", 3, values[1])])
    assert sorted(map(tuple, got.select("k", "v", "p").collect())) == expected and set(glob.glob(path + "/p=*")) == folders
    for _ in range(2):
        maintenance.compact_table(spark, path, ["k", "p"], ["p"])
    assert set(glob.glob(path + "/p=*")) == folders
    assert sorted(map(tuple, tables.scan_table(spark, path, typed=got.schema).select("k", "v", "p").collect())) == expected


def test_touched_partitions_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS day")
    stored = tables.write_partitioned_overwrite(df, path, ["day"])
    touched = tables.write_partitioned_overwrite(
        spark.createDataFrame([(NOW.date().replace(day=2),), (None,)], "day date"), str(tmp_path / "touched"))
    got = tables.in_partitions(stored, touched, ["day"])
    assert got.count() == 10
    assert "dynamicpruning" in got._jdf.queryExecution().toString().lower()


def test_unpartitioned_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int"
    for rows in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]):
        got = merge.upsert_table(spark, spark.createDataFrame(rows, schema), path, ["k"], {"v": "s.v"})
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 3), ("c", 4)]


def test_partition_columns_cannot_be_updated(spark, sample_jobs, tmp_path):
    with pytest.raises(ValueError, match="job_date"):
        merge.upsert_table(spark, silver(sample_jobs), str(tmp_path), ["job_id"], {"job_date": "s.job_date"}, ["job_date"])


def test_stored_completions(spark, sample_jobs, completions, tmp_path):
    path = str(tmp_path / "jobs")
    assert merge.merge_completions_table(spark, path, completions, NOW) is None
    merge.upsert_jobs(spark, silver(sample_jobs), path)
    got = by_id(merge.merge_completions_table(spark, path, completions, NOW))
    assert len(got) == 6 and got["train-b"].cost_usd == 30.0 and got["train-a"].cost_usd == 357.0
    unmatched = spark.createDataFrame([("nobody", NOW, 1.0, 0, 1.0)], COMPLETION_FIELDS)
    assert merge.merge_completions_table(spark, path, unmatched, NOW).count() == 6


def test_completions_of_an_unpartitioned_table(spark, sample_jobs, completions, tmp_path):
    path = str(tmp_path / "jobs")
    tables.write_partitioned_overwrite(silver(sample_jobs), path)
    got = by_id(merge.merge_completions_table(spark, path, completions, NOW, partition_by=()))
    assert len(got) == 6 and got["train-b"].cost_usd == 30.0


def test_the_delivery_that_knows_the_end_wins(spark):
    rows = [("a", None, 1.0, None, None), ("a", ago(hours=2), 1.0, 0, 5.0), ("a", ago(hours=1), 1.0, 0, 1.0), ("b", None, 1.0, None, None)]
    got = by_id(dedup.dedup_jobs(spark.createDataFrame(rows, COMPLETION_FIELDS)))
    assert got["a"].ended_at == ago(hours=1) and got["b"].ended_at is None


def test_overwrite_ignores_a_dynamic_session(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.write_partitioned_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
        got = tables.write_partitioned_overwrite(spark.createDataFrame([(3, "b")], "x int, p string"), path, ["p"])
        assert [tuple(r) for r in got.collect()] == [(3, "b")]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
