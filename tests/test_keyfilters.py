import glob
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fleetmeter.operators import merge
from fleetmeter.sources import keyfilters, tables

DAY = date(2024, 1, 1)
SCHEMA = "k string, v int, day date"


def rows_of(days, per_day=50):
    return [(f"{d}-{n}", n, DAY + timedelta(days=d)) for d in days for n in range(per_day)]


def upsert(spark, rows, path, schema=SCHEMA, filters=True, on=("k",)):
    return merge.upsert_table(spark, spark.createDataFrame(rows, schema), path, list(on), {"v": "s.v"}, ["day"], key_filters=filters)


def days_opened(df):
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles()}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed") / "t")
    upsert(spark, [*rows_of(range(90)), (None, 1, DAY), ("no day", 5, None)], path)
    return path


def test_a_delivery_opens_its_day_only(spark, stored):
    table = tables.scan_table(spark, stored)
    assert len(days_opened(table)) == 91
    keys = spark.createDataFrame([("17-3",), ("17-49",), ("new",), (None,)], "k string")
    assert days_opened(keyfilters.narrowed(table, stored, keys, ["k"])) == {"2024-01-18"}
    nowhere = keyfilters.narrowed(table, stored, keys.filter("k = 'new' OR k IS NULL"), ["k"])
    assert nowhere.schema == table.schema and nowhere.count() == 0
    unknown = keys.filter("k LIKE '17%'").unionByName(spark.createDataFrame([("no day",)], "k string"))
    assert days_opened(keyfilters.narrowed(table, stored, unknown, ["k"])) == {"2024-01-18", "__HIVE_DEFAULT_PARTITION__"}


def test_other_types_and_other_keys_leave_the_table_whole(spark, stored):
    table = tables.scan_table(spark, stored)
    assert keyfilters.narrowed(table, stored, spark.createDataFrame([(1,)], "k int"), ["k"]) is table
    assert keyfilters.narrowed(table, stored, spark.createDataFrame([("1", 1)], "k string, v int"), ["k", "v"]) is table


def test_absent_keys_are_ruled_out_and_present_ones_never(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000).select((F.col("id") * 3).alias("k"), (F.col("id") % 4).cast("int").alias("day")).write.partitionBy(
        "day").parquet(path)
    assert len(keyfilters.refresh(spark, path, ["k"])) == 4 and keyfilters.refresh(spark, path, ["k"]) == []
    table = tables.scan_table(spark, path)
    absent = spark.range(20_000).select((F.col("id") * 3 + 1).alias("k"))
    assert keyfilters.narrowed(table, path, absent, ["k"]).count() == 0
    for n in random.Random(4).sample(range(200_000), 5):
        found = keyfilters.narrowed(table, path, spark.createDataFrame([(n * 3,)], "k bigint"), ["k"])
        assert days_opened(found) == {str(n % 4)}


def test_results_are_those_without_filters(spark, tmp_path):
    delivery = [("3-1", 100, DAY + timedelta(days=3)), ("5-2", 200, DAY), ("x", 1, DAY + timedelta(days=99)), (None, 7, None)]
    results = []
    for filters in (True, False):
        path = f"{tmp_path}/{filters}"
        upsert(spark, rows_of(range(8), 5), path, filters=filters)
        before = set(glob.glob(path + "/day=*/*.parquet"))
        results.append(sorted(upsert(spark, delivery, path, filters=filters).collect(), key=str))
        left = {f.split("day=")[1][:10] for f in before - set(glob.glob(path + "/day=*/*.parquet"))}
        assert left == {"2024-01-01", "2024-01-04", "2024-01-06"}
    assert results[0] == results[1]


def test_a_filter_holds_only_for_the_files_it_was_made_from(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, rows_of(range(4), 5), path)
    extra = spark.createDataFrame([("late", 1, DAY + timedelta(days=2))], SCHEMA)
    extra.write.mode("append").partitionBy("day").parquet(path)  # by a writer that knows nothing of filters
    keys = spark.createDataFrame([("late",)], "k string")
    assert days_opened(keyfilters.narrowed(tables.scan_table(spark, path), path, keys, ["k"])) == {"2024-01-03"}
    got = upsert(spark, [("late", 9, DAY + timedelta(days=2))], path)
    assert [r.v for r in got.filter("k = 'late'").collect()] == [9]
    assert keyfilters.refresh(spark, path, ["k"]) == []


def test_a_failure_before_the_note_costs_a_scan(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(spark, rows_of(range(3), 5), path)

    def fail(*_):
        raise OSError("lost")

    def written(spark_, target, text, real=tables.write_text):
        return fail() if target.endswith(keyfilters.NOTE) else real(spark_, target, text)

    with monkeypatch.context() as m:
        m.setattr(tables, "write_text", written)
        with pytest.raises(OSError):
            upsert(spark, [("1-1", 50, DAY + timedelta(days=1)), ("mine", 1, DAY)], path)
    keys = spark.createDataFrame([("mine",)], "k string")
    found = keyfilters.narrowed(tables.scan_table(spark, path), path, keys, ["k"])
    assert found.filter("k = 'mine'").count() == 1
    assert [r.v for r in upsert(spark, [("mine", 2, DAY)], path).filter("k = 'mine'").collect()] == [2]


def test_two_partition_columns_and_odd_values(spark, tmp_path):
    path = str(tmp_path / "t x")
    rows = [(1, 1, "a/b+c=1", "é %"), (2, 1, "plain", "x"), (3, 1, None, "x")]
    schema = "k int, v int, p string, q string"
    for _ in range(2):
        merge.upsert_table(spark, spark.createDataFrame(rows, schema), path, ["k"], {"v": "s.v"}, ["p", "q"], key_filters=True)
    table = tables.scan_table(spark, path)
    for k, p in ((1, "a/b+c=1"), (2, "plain"), (3, None)):
        found = keyfilters.narrowed(table, path, spark.createDataFrame([(k,)], "k int"), ["k"])
        assert [(r.k, r.p) for r in found.collect()] == [(k, p)]
