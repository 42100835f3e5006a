"""Stored tables: scan, overwrite, and replacement of single partitions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.functions.relational import any_null

DEFAULT_FORMAT = "parquet"


def scan_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, typed: T.StructType | None = None) -> DataFrame:
    """Read a stored table. Columns that ``typed`` names get its types.

    Folder names carry no types: unless told otherwise, Spark reads the string partitions
    '01' and '1' as one number.
    """
    df = spark.read.format(fmt).load(path)
    if typed is None or fmt != "parquet":
        return df
    types = {f.name: f.dataType for f in typed}
    schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in df.schema])
    return df if schema == T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]) else spark.read.schema(schema).parquet(path)


def partition_types(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name in partition_by])


def table_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Whether a readable table lies at the path. Other read errors are passed on."""
    try:
        scan_table(spark, path, fmt)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND",
                                "DELTA_PATH_DOES_NOT_EXIST"):
            return False
        raise
    return True


def in_partitions(df: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions, whose values are a stored table.

    The least and the greatest touched value bound the scan when planning, and make the semi
    join between them one that prunes partitions at run time. Equality prunes, null-safe
    equality does not, so NULL partitions are read by a branch of their own.
    """
    ends = touched.agg(*(f(c).alias(f"{side}_{c}") for c in partition_by for side, f in (("low", F.min), ("high", F.max)))).first()
    right = touched.select(*(F.col(c).alias(f"_p_{c}") for c in partition_by))

    def within(rows: DataFrame, prefix: str) -> DataFrame:
        bounds = (F.col(prefix + c).between(ends[f"low_{c}"], ends[f"high_{c}"]) for c in partition_by)
        return rows.filter(reduce(lambda a, b: a & b, bounds))

    def joined(rows: DataFrame, values: DataFrame, same: Callable[[Column, Column], Column]) -> DataFrame:
        on = reduce(lambda a, b: a & b, (same(rows[c], values[f"_p_{c}"]) for c in partition_by))
        return rows.join(values, on, "left_semi")

    nulls = joined(df.filter(any_null(partition_by)), right, lambda a, b: a.eqNullSafe(b))
    if any(ends[f"low_{c}"] is None for c in partition_by):
        return nulls
    return joined(within(df, ""), within(right, "_p_"), lambda a, b: a == b).unionByName(nulls)


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Lay rows out for a partitioned write.

    A rebalance sends each partition value to few tasks, which keeps the file count
    low; adaptive execution splits a partition that holds much of the table.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


# ---------------------------------------------------------------- replacement that can be resumed
#
# New files are written beside the table, in their final layout. Once they are complete a marker names them all, and
# only then are old files deleted and new ones renamed into place, partition by partition. Whoever writes to the table
# next finishes a move whose marker is still there, so at every moment either the old rows or the new ones are all on disk.

STAGED, MARKER = ".staged-", ".move"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the constructor of its paths."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def data_files(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Names of the data files below a folder, by partition folder; names that start with '_' or '.' are not data."""
    fs, to_path = _hadoop(spark, root)
    found: dict[str, list[str]] = {}
    top = fs.makeQualified(to_path(root)).toUri().getPath().rstrip("/")
    walk = fs.listFiles(to_path(root), True) if fs.exists(to_path(root)) else None
    while walk is not None and walk.hasNext():
        relative = walk.next().getPath().toUri().getPath()[len(top) + 1:]
        folder, _, name = relative.rpartition("/")
        if not any(part[:1] in "_." and "=" not in part for part in relative.split("/")):
            found.setdefault(folder, []).append(name)
    return found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all."""
    fs, to_path = _hadoop(spark, path)
    out = fs.create(to_path(path + ".tmp"), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(to_path(path), False)
    if not fs.rename(to_path(path + ".tmp"), to_path(path)):
        raise OSError(f"cannot create {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, to_path = _hadoop(spark, path)
    if not fs.exists(to_path(path)):
        return None
    stream = fs.open(to_path(path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, to_path = _hadoop(spark, source)
    fs.mkdirs(to_path(target).getParent())
    if not fs.rename(to_path(source), to_path(target)):
        raise OSError(f"cannot move {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, to_path = _hadoop(spark, path)
    fs.delete(to_path(path), True)


def folder_column(spark: SparkSession, path: str) -> Column:
    """The partition folder of a scanned row, named as in ``data_files``."""
    fs, to_path = _hadoop(spark, path)
    top = fs.makeQualified(to_path(path)).toUri().getPath().rstrip("/") + "/"
    # File paths are URI-encoded, where '+' stands for itself.
    file_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    inside = F.substring(file_path, F.instr(file_path, top) + len(top), F.length(file_path))
    return F.regexp_replace(inside, "/?[^/]*$", "")


def scan_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Some partitions of a stored table, by folder; only their files are listed and read. With no
    folders, no rows of the table's schema."""
    schema = schema or scan_table(spark, path).schema
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*("/".join(filter(None, (path, f))) for f in folders))


def finish_replacement(spark: SparkSession, path: str) -> bool:
    """Finish a replacement of the table that was broken off; whether there was one. Each step may be repeated."""
    path = path.rstrip("/")
    text = read_text(spark, path + MARKER)
    if text is None:
        return False
    plan = json.loads(text)
    staged, new = plan["staged"], plan["files"]
    waiting = data_files(spark, staged)
    for folder, names in data_files(spark, path).items():
        if folder in new or plan["whole"]:
            for name in set(names) - set(new.get(folder, ())):
                _delete(spark, "/".join(filter(None, (path, folder, name))))
    for folder, names in waiting.items():
        for name in names:
            inner = "/".join(filter(None, (folder, name)))
            _move(spark, f"{staged}/{inner}", f"{path}/{inner}")
    _delete(spark, staged)
    _delete(spark, path + MARKER)
    return True


def replace_files(df: DataFrame, path: str, partition_by: Sequence[str], whole: bool, fmt: str = DEFAULT_FORMAT,
                  clear: Sequence[str] = ()) -> None:
    """Write ``df`` as it is laid out and put it in the place of the table, or of the partitions it holds.

    Partitions whose folders are in ``clear`` are emptied where ``df`` has no rows for them. The plan
    may read the table. Tables of a format with a log of its own leave the move to it, without ``clear``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    writer = df.write.format(fmt)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    if fmt == "delta":
        writer.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic").save(path)
        return
    finish_replacement(spark, path)
    staged = f"{path}{STAGED}{uuid.uuid4().hex}"
    try:
        writer.save(staged)
    except Exception:
        _delete(spark, staged)  # incomplete; the table is untouched
        raise
    write_text(spark, path + MARKER, json.dumps(
        {"staged": staged, "whole": whole, "files": {f: [] for f in clear} | data_files(spark, staged)}))
    finish_replacement(spark, path)


def write_partitioned_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                                fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Replace the whole table and return a fresh read of it. The plan may read the table."""
    replace_files(balanced(df, partition_by), path, partition_by, True, fmt)
    return scan_table(df.sparkSession, path, fmt, partition_types(df, partition_by))


def replace_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Replace an unpartitioned table."""
    return write_partitioned_overwrite(df, path, (), fmt)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Replace exactly the partitions present in ``df``, which may be computed from the table.

    The fresh read that is returned is the only valid handle on the table.
    """
    replace_files(balanced(df, partition_by), path, partition_by, False, fmt)
    return scan_table(df.sparkSession, path, fmt, partition_types(df, partition_by))
