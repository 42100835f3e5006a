"""Gold kept up to date by dates: only those are rebuilt whose source files have changed.

Beside each gold table a note names the files it was built from, by partition folder. A folder of the source whose
files differ from the note, whoever rewrote them, is rebuilt in gold, and emptied there when it has no rows any more.
Every gold table has the partitions of its source, so a folder of one is the folder of the other. The note is written
last: a failure before that costs a rebuild of the same dates.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.plans import marts, staging
from fleetmeter.session import in_utc, sized_shuffles
from fleetmeter.sources import tables

NOTE = ".sources.json"


def changed_folders(spark: SparkSession, source: str, target: str) -> tuple[list[str], bool]:
    """Folders of the source that differ from what the target was built from, and whether the target is to be built whole."""
    files = tables.data_files(spark, source)
    text = tables.read_text(spark, target + NOTE)
    if text is None or not tables.table_exists(spark, target):
        return sorted(files), True
    noted = json.loads(text)["files"]
    return sorted(f for f in files.keys() | noted.keys() if sorted(files.get(f, ())) != noted.get(f)), False


def _open_folders(spark: SparkSession, silver_jobs: str) -> set[str]:
    """Folders with jobs that have not ended, whose costs grow with time."""
    still_open = tables.scan_table(spark, silver_jobs).filter(F.col("ended_at").isNull())
    return {r[0] for r in still_open.select(tables.folder_column(spark, silver_jobs).alias("folder")).distinct().collect()}


def rebuild_changed(spark: SparkSession, source: str, target: str, partition_by: str,
                    build: Callable[[DataFrame], DataFrame], also: set[str] = frozenset(), at: str | None = None) -> list[str]:
    """Rebuild the partitions of ``target`` whose source has changed, and those in ``also``; returns their folders.

    ``build`` must derive the rows of a partition from the same partition of the source. ``at`` is noted with the files.
    """
    for path in (source, target):
        tables.finish_replacement(spark, path)
    files = {f: sorted(names) for f, names in tables.data_files(spark, source).items()}
    changed, whole = changed_folders(spark, source, target)
    changed = sorted({*changed, *also})
    if changed:
        rows = build(tables.scan_folders(spark, source, [f for f in changed if f in files]))
        with sized_shuffles(rows):
            tables.replace_files(tables.balanced(rows, [partition_by]), target, [partition_by], whole, clear=changed)
    tables.write_text(spark, target + NOTE, json.dumps({"files": files, "at": at}))
    return changed


def refresh_gold(spark: SparkSession, silver: str, gold: str, as_of: datetime | None = None) -> dict[str, list[str]]:
    """The tables of ``batch.materialize_gold`` for the dates that have changed since the last call; the first call builds all.

    Returns the rebuilt folders of each table. Dates with jobs that still run are rebuilt whenever ``as_of`` is not
    that of the last call, since their costs depend on it. Compacting a silver partition counts as a change.
    """
    costs, at = f"{gold}/int_job_costs", None if as_of is None else in_utc(as_of).isoformat()
    text = tables.read_text(spark, costs + NOTE)
    same_time = text is not None and at is not None and json.loads(text)["at"] == at
    moving = set() if same_time or text is None else _open_folders(spark, f"{silver}/jobs")

    def job_costs(jobs: DataFrame) -> DataFrame:
        return staging.int_job_costs(staging.stg_jobs(jobs), as_of)

    return {
        "int_job_costs": rebuild_changed(spark, f"{silver}/jobs", costs, "job_date", job_costs, moving, at),
        "cost_attribution": rebuild_changed(
            spark, costs, f"{gold}/cost_attribution", "job_date", marts.cost_attribution),
        "gpu_utilization_hourly": rebuild_changed(
            spark, f"{silver}/node_metrics", f"{gold}/gpu_utilization_hourly", "metric_date",
            lambda readings: marts.gpu_utilization_hourly(staging.stg_node_metrics(readings))),
        "job_performance_sla": rebuild_changed(
            spark, f"{silver}/inference", f"{gold}/job_performance_sla", "log_date",
            lambda requests: marts.job_performance_sla(staging.stg_inference(requests))),
    }


def stored_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    return {n: tables.scan_table(spark, f"{gold}/{n}")
            for n in ("int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla")}
