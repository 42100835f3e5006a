import os
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetmeter.session import build_session  # noqa: E402

NOW = datetime(2024, 1, 15, 12)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


JOB_FIELDS = (
    "job_id string, org_id string, user_id string, gpu_type string, gpu_count int, framework string, "
    "model_arch string, started_at timestamp, ended_at timestamp, duration_hours double, exit_code int, "
    "cost_usd double, is_late_arrival string"
)
COMPLETION_FIELDS = "job_id string, ended_at timestamp, duration_hours double, exit_code int, cost_usd double"


def ago(**kw):
    return NOW - timedelta(**kw)


@pytest.fixture
def sample_jobs(spark):
    """Finished overnight, still open, out of memory, fault of the platform, unknown GPU, NULL count."""
    rows = [
        ("train-a", "vision", "ines", "H100-SXM5-80GB", 8, "deepspeed", "llm-34b", ago(hours=20), ago(hours=9, minutes=30),
         10.5, 0, 357.0, "false"),
        ("train-b", "speech", "omar", "A100-SXM4-80GB", 2, "pytorch", "whisper", ago(hours=6), None,
         None, None, None, "true"),
        ("sweep-1", "vision", "ines", "RTX-4090", 4, "jax", "resnet", ago(minutes=45), ago(minutes=30),
         0.25, 137, 0.74, "false"),
        ("sweep-2", "speech", "lena", "A10G", 3, "jax", "resnet", ago(hours=7), ago(hours=4), 3.0, 143, 0.0, "false"),
        ("odd-gpu", "speech", "lena", "TPU-X", 1, "tensorflow", "llm-7b", ago(hours=3), ago(hours=1), 2.0, 1, None, "false"),
        ("no-count", "vision", "omar", "A100-PCIe-40GB", None, "pytorch", "bert", ago(hours=2), ago(minutes=30),
         1.5, 0, 12.5, "true"),
    ]
    return spark.createDataFrame(rows, JOB_FIELDS)


@pytest.fixture
def completions(spark):
    """The end of the open job, an hour before now."""
    return spark.createDataFrame([("train-b", ago(hours=1), 5.0, 0, 30.0)], COMPLETION_FIELDS)
