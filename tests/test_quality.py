import pytest
from pyspark.sql import functions as F

from conftest import NOW
from fleetmeter.operators import enrich, quality as Q

ROWS = [("a", 1, 5.0, "x"), ("a", 2, -1.0, "y"), ("b", None, None, None), (None, 900, 7.0, "x")]
FIELDS = "k string, n int, cost double, c string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, FIELDS)


def results(df):
    return [(r.considered, r.failing, r.observed, r.success) for r in df.collect()]


def test_each_expectation(table):
    got = results(Q.run_expectations(table, [
        Q.expect_row_count_between(4), Q.expect_row_count_between(5), Q.expect_row_count_between(high=4),
        Q.expect_not_null("k"), Q.expect_not_null("k", mostly=0.75),
        Q.expect_unique("k"), Q.expect_unique("c"), Q.expect_unique("n"),
        Q.expect_between("n", 1, 512), Q.expect_between("n", 1, 512, mostly=0.66),
        Q.expect_in_set("c", ["x"], mostly=0.6),
        Q.expect_mean_between("cost", 3.0, 4.0), Q.expect_median_between("n", 1, 2), Q.expect_median_between("n", 3),
    ]))
    third = pytest.approx(2 / 3)
    assert got == [
        (4, None, 4.0, True), (4, None, 4.0, False), (4, None, 4.0, True),
        (4, 1, 0.75, False), (4, 1, 0.75, True),
        (3, 2, pytest.approx(1 / 3), False), (3, 2, pytest.approx(1 / 3), False), (3, 0, 1.0, True),
        (3, 1, third, False), (3, 1, third, True),
        (3, 1, third, True),
        (3, None, pytest.approx(11 / 3), True), (3, None, 2.0, True), (3, None, 2.0, False),
    ]


def test_nothing_to_consider(table):
    empty = table.withColumn("n", F.lit(None).cast("int"))
    got = results(Q.run_expectations(empty, [
        Q.expect_between("n", 1, 2), Q.expect_unique("n"), Q.expect_mean_between("n", 0, 1), Q.expect_median_between("n", 0, 1)]))
    assert [g[3] for g in got] == [True, True, False, False]


def test_gate_blocks_or_promotes(spark, sample_jobs):
    silver = enrich.silver_jobs(sample_jobs.withColumn("dataset_size_gb", F.lit(1.0)), NOW)
    checks = Q.silver_jobs_gate(silver)
    failed = [r.expectation for r in checks.collect() if not r.success]
    assert failed == ["row_count_between", "not_null", "in_set"] and checks.count() == 14
    assert not checks.first().gate_passed
    ran = []
    assert Q.promote_if_passed(checks, lambda: ran.append(1)) is None and not ran
    assert Q.promote_if_passed(checks.filter("success"), lambda: "gold") == "gold"


def test_failing_rows(table):
    assert Q.failing_unique(table, "k").collect() == [("a", 2)]
    assert Q.failing_expression(table, F.col("cost") >= 0).count() == 1


def test_column_test_summary(table):
    got = Q.run_column_tests({"t": table}, [
        Q.unique("t", "k"), Q.not_null("t", "n"), Q.accepted_values("t", "c", ["x", "y"]),
        Q.expression("t", "cost", lambda x: x >= 0), Q.expression("t", "n", Q.share_or_null)]).collect()
    assert [(r.test, r.failures) for r in got] == [
        ("unique", 1), ("not_null", 1), ("accepted_values", 0), ("expression", 1), ("expression", 2)]
    assert [len(Q.tests_of_kind(k)) for k in ("unique", "not_null", "accepted_values", "expression")] == [3, 9, 2, 7]


def test_negative_costs_and_sanity(spark, sample_jobs):
    mart = spark.createDataFrame([("a", "o", None, -1.0), ("b", "o", None, 0.0), ("c", "o", None, None)],
                                 "attribution_id string, org_id string, job_date date, total_cost_usd double")
    assert [r.attribution_id for r in Q.negative_costs(mart).collect()] == ["a"]
    assert {r.check_name: r.failures for r in Q.sanity_jobs(sample_jobs).collect()} == {
        "started_before_2020": 0, "gpu_count_below_one": 0, "ended_not_after_start": 0}
    broken = sample_jobs.withColumns({"gpu_count": F.lit(0), "ended_at": F.col("started_at"),
                                      "started_at": F.lit("1970-01-01").cast("timestamp")})
    assert {r.check_name: r.failures for r in Q.sanity_jobs(broken).collect()} == {
        "started_before_2020": 6, "gpu_count_below_one": 6, "ended_not_after_start": 0}
