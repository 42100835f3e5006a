"""A replacement that breaks off at any step loses no row: the next writer finishes it."""

import os

import pytest
from pyspark.sql import functions as F

from fleetmeter.operators import maintenance, merge
from fleetmeter.sources import tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, day string").repartition(3)


OLD = [(i, f"old{i}", f"d{i % 4}") for i in range(40)]
NEW = [(i, f"new{i}", f"d{i % 2}") for i in range(100, 130)]


def rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "v", "day").collect()))


def break_at(monkeypatch, step, after):
    """Let a step of the move fail at its n-th call."""
    whole, calls = getattr(tables, step), []

    def broken(*args):
        calls.append(args)
        if len(calls) > after:
            raise RuntimeError("broken off")
        return whole(*args)

    monkeypatch.setattr(tables, step, broken)


@pytest.mark.parametrize("partition_by", [["day"], []])
@pytest.mark.parametrize("step,after", [("write_text", 0), ("read_text", 1), ("_delete", 0), ("_delete", 2), ("_move", 0), ("_move", 1)])
def test_every_step_can_break(spark, tmp_path, monkeypatch, partition_by, step, after):
    if (step, after) == ("_move", 1) and not partition_by:
        pytest.skip("one file, one move")
    path = str(tmp_path / "t")
    tables.write_partitioned_overwrite(frame(spark, OLD), path, partition_by)
    replace = tables.replace_partitions if partition_by else lambda df, p, _: tables.replace_table(df, p)
    expected = sorted(([r for r in OLD if r[2] in ("d2", "d3")] if partition_by else []) + NEW)
    with monkeypatch.context() as patched:
        break_at(patched, step, after)
        with pytest.raises(RuntimeError):
            replace(frame(spark, NEW), path, partition_by)
    finished = tables.finish_replacement(spark, path)
    assert finished == (step != "write_text")
    assert rows(spark, path) == (expected if finished else sorted(OLD))
    if not finished:  # nothing had begun: the table is the old one, and the call can be made again
        replace(frame(spark, NEW), path, partition_by)
        assert rows(spark, path) == expected
    assert not tables.finish_replacement(spark, path)
    assert not [x for x in os.listdir(tmp_path) if x != "t" and tables.STAGED not in x]


def test_staging_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned_overwrite(frame(spark, OLD), path, ["day"])
    bad = frame(spark, NEW).withColumn("v", F.when(F.col("id") == 110, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        tables.replace_partitions(bad, path, ["day"])
    assert rows(spark, path) == sorted(OLD) and os.listdir(tmp_path) == ["t"]


def test_next_upsert_finishes_first(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_partitioned_overwrite(frame(spark, OLD), path, ["day"])
    first = frame(spark, [(1, "first", "d1"), (500, "more", "d1")])
    with monkeypatch.context() as patched:
        break_at(patched, "_move", 0)
        with pytest.raises(RuntimeError):
            merge.upsert_table(spark, first, path, ["id"], {"v": "s.v"}, ["day"])
    merge.upsert_table(spark, frame(spark, [(2, "second", "d2")]), path, ["id"], {"v": "s.v"}, ["day"])
    expected = {**{i: v for i, v, _ in OLD}, 1: "first", 500: "more", 2: "second"}
    assert {i: v for i, v, _ in rows(spark, path)} == expected


def test_compaction_that_breaks_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for part in range(4):
        frame(spark, OLD[part::4]).write.mode("append").partitionBy("day").parquet(path)
    with monkeypatch.context() as patched:
        break_at(patched, "_delete", 2)
        with pytest.raises(RuntimeError):
            maintenance.compact_table(spark, path, ["id", "v"], ["day"])
    maintenance.compact_table(spark, path, ["id", "v"], ["day"])
    assert rows(spark, path) == sorted(OLD)


def test_replacing_a_table_from_itself(spark, tmp_path):
    path = str(tmp_path / "a table+1")
    tables.write_partitioned_overwrite(frame(spark, OLD + [(77, "null day", None), (78, "odd", "x/y =z%")]), path, ["day"])
    tables.write_partitioned_overwrite(spark.read.parquet(path).withColumn("v", F.upper("v")), path, ["day"])
    assert sorted(r[1] for r in spark.read.parquet(path).select("id", "v").collect()) == sorted([v.upper() for _, v, _ in OLD] + ["NULL DAY", "ODD"])
