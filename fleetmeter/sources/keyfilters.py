"""Stored Bloom filters of a table's keys, one per partition, asked before key columns are scanned.

A filter is rows of 1,024 bits: a key's first hash picks the row, two more set one bit in each of its sixteen words.
Rows are sized for 32 to 64 bits a key, which lets about one absent key in a million through. Filters lie beside the
table (``<table>.keys``). A note of the files each was made from tells whether it still holds: a partition whose
files have changed since, by whatever writer, has no filter until the next ``refresh``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions.relational import any_null
from fleetmeter.session import sized_shuffles
from fleetmeter.sources import tables

FILTERS, NOTE = ".keys", ".keys.json"
WORDS = 16
KEYS_PER_ROW = 32  # at most, on average; a filter's rows are a power of two
_PLACES_PER_HASH = 10  # six bits each

#: Types whose equal values have equal hashes. Floating point is not one: 0.0 and -0.0 differ.
_HASHABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType,
             T.BooleanType, T.BinaryType, T.DecimalType)


def _one_at(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _masks() -> list[Column]:
    """One bit for each word of a filter row, from the key's hash ``h``."""
    hashes = [F.xxhash64("h", F.lit(seed)) for seed in (1, 2)]
    places = (F.shiftrightunsigned(hashes[i // _PLACES_PER_HASH], 6 * (i % _PLACES_PER_HASH)) for i in range(WORDS))
    return [_one_at(place.bitwiseAND(F.lit(63))) for place in places]


def _row_number() -> Column:
    """The row of key ``h`` in a filter of 2**level rows."""
    return F.col("h").bitwiseAND(_one_at(F.col("level")) - 1).alias("row")


def _words() -> list[str]:
    return [f"w{i}" for i in range(WORDS)]


def _comparable(keys: DataFrame, table: DataFrame, on: Sequence[str]) -> bool:
    def same(c: str) -> bool:
        kind = table.schema[c].dataType
        return kind == keys.schema[c].dataType and (kind == T.StringType() or isinstance(kind, _HASHABLE))

    return all(same(c) for c in on)


def _note(spark: SparkSession, path: str, on: Sequence[str]) -> Mapping[str, Any]:
    """Files and level of each filter by folder; nothing when there are none for this key."""
    text = tables.read_text(spark, path + NOTE)
    found = json.loads(text) if text else {}
    return found["filters"] if found.get("on") == list(on) else {}


def refresh(spark: SparkSession, path: str, on: Sequence[str]) -> list[str]:
    """Make the filters of all partitions that have none which holds; returns their folders.

    Reads the key columns of those partitions once. Hashes are shuffled, not keys, and spread by filter row, so a
    crowded partition is no crowded task. A failure between the filters and their note costs a later refresh only.
    """
    path = path.rstrip("/")
    noted, files = _note(spark, path, on), tables.data_files(spark, path)
    stale = sorted(f for f, names in files.items() if f not in noted or noted[f]["files"] != sorted(names))
    if not stale:
        return []
    rows = tables.scan_folders(spark, path, stale)
    folder = tables.folder_column(spark, path).alias("folder")
    counts = {r["folder"]: r["count"] for r in rows.groupBy(folder).count().collect()}
    levels = {f: max(0, math.ceil(math.log2(max(1, counts.get(f, 0)) / KEYS_PER_ROW))) for f in stale}
    numbered = spark.createDataFrame([(f, n, levels[f]) for n, f in enumerate(stale)], "folder string, number int, level int")
    with sized_shuffles(rows):
        hashes = rows.filter(~any_null(on)).select(F.xxhash64(*on).alias("h"), folder).join(numbered, "folder")
        dealt = hashes.select("number", "level", _row_number(), "h").repartition("number", "level", "row")
        filters = dealt.groupBy("number", "level", "row").agg(*(F.bit_or(m).alias(w) for m, w in zip(_masks(), _words())))
        named = filters.join(numbered.select("number", "folder"), "number").drop("number")
        tables.replace_files(tables.balanced(named, ["folder"]), path + FILTERS, ["folder"], whole=not noted)
    kept = {f: noted[f] for f in files if f in noted and f not in stale}
    made = {f: {"files": sorted(files[f]), "level": levels[f]} for f in stale}
    tables.write_text(spark, path + NOTE, json.dumps({"on": list(on), "filters": kept | made}))
    return stale


def narrowed(table: DataFrame, path: str, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The stored table without partitions whose filter rules out every one of the keys.

    Partitions without a filter that holds stay in. Keys of other types than the table's leave it whole. The filters
    are scanned, joined with the hashes of the keys, and their folders' names collected.
    """
    spark, path = table.sparkSession, path.rstrip("/")
    noted, files = _note(spark, path, on), tables.data_files(spark, path)
    levels = {f: noted[f]["level"] for f, names in files.items() if f in noted and noted[f]["files"] == sorted(names)}
    if not levels or not _comparable(keys, table, on):
        return table
    schema = T.StructType.fromDDL("level int, row bigint, " + ", ".join(f"{w} bigint" for w in _words()) + ", folder string")
    filters = spark.read.schema(schema).parquet(path + FILTERS)
    hashes = keys.filter(~any_null(on)).select(F.xxhash64(*on).alias("h")).distinct()
    sizes = F.explode(F.array(*(F.lit(n) for n in sorted(set(levels.values()))))).alias("level")
    asked = hashes.select("h", sizes).select("h", "level", _row_number())
    held = reduce(lambda a, b: a & b, (F.col(w).bitwiseAND(m) == m for w, m in zip(_words(), _masks())))
    hit = {r["folder"] for r in filters.join(asked, ["level", "row"]).filter(held).select("folder").distinct().collect()}
    wanted = sorted(f for f in files if f not in levels or f in hit)
    return tables.scan_folders(spark, path, wanted, table.schema)
