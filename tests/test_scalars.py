import hashlib
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import NOW, ago
from fleetmeter.functions import scalars as S
from fleetmeter.operators import enrich
from fleetmeter.plans import staging


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_round_goes_half_away_on_the_scaled_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,), (None,)], "x double")
    got = values(df, S.round_half_away(F.col("x"), 2).alias("r"))
    assert got == [(1.0,), (2.5,), (-2.5,), (0.13,), (None,)]


def test_every_known_gpu_has_a_price_and_others_none(spark):
    df = spark.createDataFrame([(g,) for g in [*S.PRICE_BOOK, "TPU", None]], "g string")
    got = values(df, "g", S.price_per_gpu_hour(F.col("g")).alias("p"))
    assert got == [*S.PRICE_BOOK.items(), ("TPU", None), (None, None)]
    assert S.PRICE_BOOK["H100-SXM5-80GB"] > S.PRICE_BOOK["A100-SXM4-80GB"]


def test_lenient_boolean_turns_junk_to_null(spark):
    df = spark.createDataFrame([("true",), ("false",), ("maybe",), (None,)], "x string")
    assert values(df, S.lenient_boolean(F.col("x")).alias("b")) == [(True,), (False,), (None,), (None,)]


def test_success_flag_is_null_without_exit_code(spark):
    df = spark.createDataFrame([(0,), (137,), (None,)], "x int")
    assert values(df, S.exited_cleanly(F.col("x")).alias("b")) == [(True,), (False,), (None,)]


@pytest.mark.parametrize(
    ("model", "p99", "breached", "size"),
    [
        ("llama-405b", 8000.0, False, "xl"), ("llama-405b", 8000.1, True, "xl"),
        ("llama-70b", 5000.0, False, "large"), ("llama-70b", 5001.0, True, "large"),
        ("codellama-34b", 2001.0, True, "medium"), ("mixtral-8x7b", 1999.0, False, "medium"),
        ("whisper", 2000.0, False, "small"), ("whisper", None, None, "small"), (None, 2001.0, True, "small"),
    ],
)
def test_slo_limits_and_size_tiers(spark, model, p99, breached, size):
    df = spark.createDataFrame([(model, p99)], "m string, p double")
    got = values(df, S.slo_breached(F.col("m"), F.col("p")).alias("b"), S.model_size_tier(F.col("m")).alias("s"))
    assert got == [(breached, size)]


def test_gpu_tier(spark):
    df = spark.createDataFrame([("H100-X",), ("A100-PCIe",), ("RTX-H100",), (None,)], "g string")
    assert [r[0] for r in values(df, S.gpu_tier(F.col("g")).alias("t"))] == [
        "flagship", "performance", "standard", "standard"]


def test_surrogate_key_formats(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    got = values(df, S.surrogate_key(["x", "y", "z"]).alias("k"),
                 S.surrogate_key(["x", "y", "z"], *S.KEY_FORMAT_PACKAGE).alias("p"))[0]
    assert got == (
        hashlib.md5(b"a||_null_||3").hexdigest(),
        hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest(),
    )


def test_rates_and_labels(spark):
    df = spark.createDataFrame([(1, 3, 90.0), (0, 0, 70.0), (2, 2, 65.0), (1, 8, None)], "a bigint, n bigint, u double")
    got = values(df, S.rate(F.col("a"), F.col("n")).alias("r"), S.compliance_rate(F.col("a"), F.col("n")).alias("c"),
                 S.capacity_pressure(F.col("u")).alias("p"))
    assert got == [(0.3333, 0.6667, "high"), (None, 1.0, "medium"), (1.0, 0.0, "low"), (0.125, 0.875, None)]


def exact(spark, x, partitions=3):
    df = spark.createDataFrame([(v,) for v in x], "x double").repartition(partitions)
    return values(df.agg(S.exact_sum(F.col("x")).alias("s"), S.exact_avg(F.col("x")).alias("a")), "s", "a")[0]


def test_sum_is_nearest_to_the_exact_total(spark):
    rng = random.Random(1)
    kinds = [lambda: rng.gauss(0, 1), lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15), lambda: 4e-10, lambda: round(rng.uniform(0, 100), 2),
             lambda: -1e-7 * rng.random(), lambda: rng.choice([1e18, -1e18, 1.0, 1e-11]), lambda: rng.choice([1e15, -1e15]) + rng.random()]
    for kind in kinds:
        x = [kind() for _ in range(rng.randint(1, 400))]
        nearest = float(sum(map(Fraction, x)))
        assert {exact(spark, x, n) for n in (1, 16)} == {(nearest, nearest / len(x))}
    assert exact(spark, [1e18, 3e-10, -1e18, -3e-10, None]) == (0.0, 0.0)


def test_sum_of_special_values(spark):
    inf, nan = math.inf, math.nan
    assert exact(spark, [inf, 1.0]) == (inf, inf) and exact(spark, [-inf, 1e300]) == (-inf, -inf)
    assert all(map(math.isnan, exact(spark, [nan, 1.0]) + exact(spark, [inf, -inf, 2.0])))
    assert exact(spark, [None]) == (None, None) and exact(spark, [1e300, 1.0, None]) == (1e300, 5e299)


def test_parts_of_groups_add_up(spark):
    rng = random.Random(2)
    rows = [(i % 3, i % 17, rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, h int, x double")
    inner = df.groupBy("g", "h").agg(S.exact_parts(F.col("x")).alias("p"))
    got = {r.g: r.s for r in inner.groupBy("g").agg(S.parts_total(S.merged_parts(F.col("p"))).alias("s")).collect()}
    assert got == {g: float(sum(Fraction(x) for h, _, x in rows if h == g)) for g in range(3)}


def test_day_of_week_starts_on_sunday(spark):
    df = spark.sql("SELECT timestamp '2024-01-14 10:00:00' AS t UNION ALL SELECT timestamp '2024-01-20 10:00:00'")
    assert sorted(values(df, S.day_of_week(F.col("t")).alias("d"))) == [(0,), (6,)]


def test_billing_rules(spark, sample_jobs):
    silver = enrich.silver_jobs(sample_jobs.withColumn("dataset_size_gb", F.lit(1.0)), NOW)
    costs = staging.int_job_costs(staging.stg_jobs(silver), NOW)
    got = {r.job_id: (r.billable_hours, r.cost_usd, r.job_status) for r in costs.collect()}
    assert got == {
        "train-a": (10.5, 357.0, "succeeded"),
        "train-b": (6.0, 36.0, "running"),
        "sweep-1": (0.25, 0.74, "oom_killed"),
        "sweep-2": (0.0, 0.0, "platform_error"),
        "odd-gpu": (2.0, None, "failed"),
        "no-count": (1.5, None, "succeeded"),
    }


def test_running_platform_fault_is_free_and_unknown_gpu_has_no_cost(spark):
    rows = [("a", 143, None, 1, None), ("b", 0, NOW, 1, None), ("c", 1, NOW, 1, 1.0)]
    df = spark.createDataFrame(rows, "job_id string, exit_code int, ended_at timestamp, gpu_count int, price double")
    hours = S.billable_hours(F.col("exit_code"), F.col("ended_at"), F.lit(2.0), F.lit(ago(hours=1)), NOW)
    got = values(df, S.job_cost(F.col("exit_code"), hours, F.col("gpu_count"), F.col("price")).alias("c"),
                 S.job_status(F.col("exit_code"), F.col("ended_at")).alias("s"))
    assert got == [(0.0, "running"), (None, "succeeded"), (2.0, "failed")]


def test_elapsed_hours_keeps_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-01-15 11:59:59.500000' AS t")
    assert values(df, S.elapsed_hours(F.col("t"), NOW).alias("h")) == [(0.5 / 3600,)]
