import glob
import os

import pytest
from pyspark.sql import functions as F

from checks.registry import AS_OF, Inputs, _stored_silver
from conftest import DATA
from fleetmeter.operators import merge
from fleetmeter.plans import batch, incremental
from fleetmeter.sources import tables
from test_batch import same_rows

TABLES = ("int_job_costs", "cost_attribution", "gpu_utilization_hourly", "job_performance_sla")


def files_of(gold):
    return {f[len(gold) + 1:] for f in glob.glob(f"{gold}/*/*=*/*.parquet")}


def dates(files):
    return sorted({tuple(f.split("/")[:2]) for f in files})


@pytest.fixture
def lake(spark, tmp_path):
    """Silver whose completions have not come in, and gold built from it."""
    i = Inputs(spark, DATA)
    silver, gold = _stored_silver(i, i.silver_jobs()), str(tmp_path / "gold")
    first = incremental.refresh_gold(spark, silver, gold, AS_OF)
    assert set(first) == set(TABLES) and len(first["int_job_costs"]) == 13
    return i, silver, gold


def equals_full_rebuild(spark, silver, gold, as_of=AS_OF):
    full = batch.materialize_gold(spark, silver, gold + "-full", as_of)
    return all(same_rows(df, full[n]) for n, df in incremental.stored_gold(spark, gold).items())


def test_a_late_completion_rewrites_one_date_of_each_mart_it_touches(spark, lake):
    i, silver, gold = lake
    before = files_of(gold)
    none = incremental.refresh_gold(spark, silver, gold, AS_OF)
    assert none == dict.fromkeys(TABLES, []) and files_of(gold) == before

    open_job = tables.scan_table(spark, f"{silver}/jobs").filter("ended_at IS NULL").orderBy("job_id").first()
    late = i.completions().filter(F.col("job_id") == open_job.job_id)
    merge.merge_completions_table(spark, f"{silver}/jobs", late, AS_OF, key_filters=True)
    day = f"job_date={open_job.job_date}"
    done = incremental.refresh_gold(spark, silver, gold, AS_OF)
    assert done == {"int_job_costs": [day], "cost_attribution": [day], "gpu_utilization_hourly": [], "job_performance_sla": []}
    assert dates(before - files_of(gold)) == [("cost_attribution", day), ("int_job_costs", day)]
    assert equals_full_rebuild(spark, silver, gold)


def test_time_moves_the_costs_of_open_jobs_and_gone_dates_go(spark, lake):
    _, silver, gold = lake
    jobs = tables.scan_table(spark, f"{silver}/jobs")
    still_open = {f"job_date={r[0]}" for r in jobs.filter("ended_at IS NULL").select("job_date").distinct().collect()}
    later = AS_OF.replace(day=3)
    assert set(incremental.refresh_gold(spark, silver, gold, later)["cost_attribution"]) == still_open
    assert equals_full_rebuild(spark, silver, gold, later)

    gone = sorted(os.listdir(f"{silver}/inference"))[-1]
    gone = gone if gone.startswith("log_date=") else sorted(d for d in os.listdir(f"{silver}/inference") if d.startswith("log_date="))[-1]
    kept = tables.scan_table(spark, f"{silver}/inference").filter(F.col("log_date") != gone.split("=")[1])
    tables.write_partitioned_overwrite(kept, f"{silver}/inference", ["log_date"])
    assert gone in incremental.refresh_gold(spark, silver, gold, later)["job_performance_sla"]
    assert not glob.glob(f"{gold}/job_performance_sla/{gone}/*.parquet")
    assert tables.scan_table(spark, f"{gold}/job_performance_sla").filter(F.col("log_date") == gone.split("=")[1]).count() == 0


def test_a_failure_before_the_note_is_made_good(spark, lake, monkeypatch):
    i, silver, gold = lake
    merge.merge_completions_table(spark, f"{silver}/jobs", i.completions().filter("job_id < 'job-3'"), AS_OF)

    def failing(spark_, path, text, real=tables.write_text):
        if path.endswith("cost_attribution" + incremental.NOTE):
            raise OSError("lost")
        return real(spark_, path, text)

    with monkeypatch.context() as m:
        m.setattr(tables, "write_text", failing)
        with pytest.raises(OSError):
            incremental.refresh_gold(spark, silver, gold, AS_OF)
    again = incremental.refresh_gold(spark, silver, gold, AS_OF)
    assert again["int_job_costs"] == [] and again["cost_attribution"]
    assert equals_full_rebuild(spark, silver, gold)
