import math
import random
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetmeter.functions import percentiles as P
from fleetmeter.functions.percentiles import Percentile, approx_percentile_columns, select_percentiles


def expected(xs, q):
    return None if not xs else float(np.quantile(np.array(xs, dtype=float), q))


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))


def check(spark, rows):
    """Rows of (group, flag, value), against numpy per group."""
    df = spark.createDataFrame(rows, "g string, flag boolean, v double")
    flagged = F.col("flag")
    wanted = [Percentile("p0", 0.0), Percentile("p50", 0.5), Percentile("p99", 0.99), Percentile("p100", 1.0),
              Percentile("f50", 0.5, flagged), Percentile("f95", 0.95, flagged)]
    got = {r.g: r.asDict() for r in select_percentiles(df, ["g"], "v", wanted).collect()}
    groups = {g for g, _, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        everything = [v for k, _, v in rows if k == g and v is not None]
        some = [v for k, f, v in rows if k == g and f and v is not None]
        for p in wanted:
            xs = some if p.where is not None else everything
            assert close(got[g][p.name], expected(xs, p.q)), (g, p.name)


def test_mixed_groups(spark):
    rnd = random.Random(1)
    rows = [("hot", rnd.random() < 0.5, round(rnd.lognormvariate(5, 1), 2)) for _ in range(3000)]
    rows += [("flat", True, 0.0)] * 50 + [("one", False, -3.25)] + [(None, True, x / 7) for x in range(-40, 40)]
    rows += [("empty", True, None), ("wide", True, -1e300), ("wide", True, 1e300), ("wide", False, 1e-300)]
    check(spark, rows)


def test_values_that_share_a_coarse_bucket(spark):
    base = 1000.0
    rows = [("a", i % 3 == 0, math.nextafter(base, 2e3) if i % 2 else base) for i in range(40)]
    rows += [("a", True, base + i * 1e-7) for i in range(200)] + [("a", False, base + i * 1e-13) for i in range(50)]
    check(spark, rows)


def test_without_groups(spark):
    df = spark.createDataFrame([(float(x),) for x in range(101)], "v double")
    row = select_percentiles(df, [], "v", [Percentile("m", 0.5), Percentile("p", 0.333)]).first()
    assert row.m == 50.0 and close(row.p, 33.3)
    nothing = select_percentiles(df.filter("v < 0"), [], "v", [Percentile("m", 0.5)]).collect()
    assert [r.m for r in nothing] == [None]


def test_nan_sorts_last(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    row = select_percentiles(df, [], "v", [Percentile("low", 0.0), Percentile("mid", 0.5), Percentile("top", 1.0),
                                           Percentile("inf", 0.75)]).first()
    assert row.low == float("-inf") and row.mid == 2.0 and math.isnan(row.top) and row.inf == float("inf")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.booleans(),
              st.floats(allow_nan=False, allow_infinity=False, width=32)),
    min_size=1, max_size=60))
def test_any_values(spark, rows):
    check(spark, rows)


def test_same_bits_whatever_the_partitioning_and_lazy(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.rand(3) * 1000).alias("v"))
    wanted = [Percentile("p50", 0.5), Percentile("p95", 0.95, F.col("v") > 10)]
    df = df.cache()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    plan = select_percentiles(df, ["g"], "v", wanted)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs
    results = [sorted(map(tuple, select_percentiles(df.repartition(n), ["g"], "v", wanted).collect())) for n in (1, 64)]
    assert results[0] == results[1] == sorted(map(tuple, plan.collect()))
    whole = sorted(map(tuple, df.groupBy("g").agg(F.percentile("v", 0.5), F.percentile(F.when(F.col("v") > 10, F.col("v")), 0.95)).collect()))
    assert np.allclose(whole, results[0], rtol=1e-12)


def test_sketch_returns_a_value_near_the_rank(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    row = df.agg(*approx_percentile_columns("v", [Percentile("p", 0.9), Percentile("q", 0.5, F.col("v") < 11)])).first()
    assert abs(row.p - 900) <= 1 and row.q == 5.0


def test_bits_are_in_the_order_of_the_doubles(spark):
    rng = random.Random(3)
    values = {0.0, 5e-324, 2.0**-1022, math.nextafter(2.0**-1022, 0), 1.7976931348623157e308, math.inf}
    for e in range(-1074, 1024):
        x = math.ldexp(1.0, e)
        values |= {x, math.nextafter(x, 0), math.nextafter(x, math.inf), x * rng.uniform(1, 2)}
    values = {x for x in values if x <= math.inf} | {-x for x in values}
    df = spark.createDataFrame([(x,) for x in values], "v double")
    got = dict(df.select("v", P.ordered_bits(F.col("v"))).collect())
    expected = {x: (1 if x >= 0 else -1) * struct.unpack("<q", struct.pack("<d", abs(x)))[0] for x in values}
    assert got == expected
    nan, null = (r[0] for r in spark.sql("SELECT double('NaN') AS v UNION ALL SELECT null").select(P.ordered_bits(F.col("v"))).collect())
    assert nan == 2**63 - 1 and null is None


def test_close_values_are_told_apart_in_small_parts(spark, monkeypatch):
    """All values of a group share the first bits; parts of 2**10 values instead of 2**21 stand for a larger group."""
    monkeypatch.setattr(P, "PART_BITS", 10)
    base = 1000.0
    values = [base + i * math.ulp(base) for i in random.Random(1).sample(range(2**18), 40_000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", -v) for v in values[:99]], "g string, v double").repartition(4)
    wanted = [P.Percentile("p01", 0.01), P.Percentile("p50", 0.5), P.Percentile("p99", 0.99)]
    got = {r.g: (r.p01, r.p50, r.p99) for r in P.select_percentiles(df, ["g"], "v", wanted).collect()}
    exact = {r.g: tuple(r.p) for r in df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("p")).collect()}
    assert got.keys() == exact.keys() and all(got[g] == pytest.approx(exact[g], rel=1e-15) for g in exact)
