import pytest

import __spark_entry__ as entry_module
from checks import oracle, registry
from checks.verify import compare, duck
from conftest import DATA

SAMPLE = ["merge_completions", "upsert_inference", "cost_attribution", "gpu_utilization_hourly", "upsert_string_partitions", "promote_rejected",
          "job_performance_sla", "dashboard_summary", "inference_stream_ingest", "silver_jobs_gate"]


def test_every_query_has_a_counterpart():
    assert set(registry.queries()) == set(oracle.oracle_sql()) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_flagship(spark):
    assert entry_module.entry(spark).count() == 4


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_other_engine(spark, con, name):
    assert compare(spark, con, DATA, name) == ""
