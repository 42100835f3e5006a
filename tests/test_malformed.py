import json

import pytest
from pyspark.sql import functions as F

from checks.registry import AS_OF
from checks.verify import compare, duck
from conftest import DATA, NOW
from fleetmeter import schemas
from fleetmeter.plans import batch
from fleetmeter.sources import files, tables
from fleetmeter.streaming import ingest

JOB = {"job_id": "a", "org_id": "o", "user_id": "u", "gpu_type": "A10G", "gpu_count": 2, "framework": "jax",
       "model_arch": "bert", "dataset_size_gb": 1.0, "started_at": "2024-01-15T00:00:00Z", "ended_at": "2024-01-15T02:00:00Z",
       "duration_hours": 2.0, "exit_code": 0, "cost_usd": 3.0, "is_late_arrival": "false"}
METRIC = "2024-01-15T00:00:00Z,n1,{},0,A10G,r1,{},20.0,60.0,150.0"
HEADER = "timestamp,node_id,gpu_id,gpu_index,gpu_type,rack_id,gpu_util_pct,memory_util_pct,temp_celsius,power_watts"


def folder(tmp_path, name, lines, suffix="json"):
    (tmp_path / name).mkdir(parents=True)
    (tmp_path / name / f"part.{suffix}").write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def outputs(spark, path, raw):
    checked = files.read_checked(spark, path, raw)
    return files.readable(checked, raw), {r.text: r.kept for r in files.malformed(checked, raw).collect()}


def test_json_lines(spark, tmp_path):
    whole, typed = json.dumps(JOB), json.dumps(JOB | {"job_id": "b", "gpu_count": "many"})
    path = folder(tmp_path, "jobs", [whole, typed, whole[:40], "", "not json", json.dumps(JOB | {"job_id": None})])
    rows, aside = outputs(spark, path, files.JOB_EVENTS)
    assert aside == {typed: True, whole[:40]: False, "not json": False}
    got = sorted(((r.job_id, r.gpu_count) for r in rows.collect()), key=str)
    assert got == [("a", 2), ("b", None), (None, 2)]  # a row of sound JSON without a key is the gate's business
    # Only rows that came from lines without a key are missing.
    plain = files.read_job_events(spark, path)
    assert rows.columns == plain.columns
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).filter("job_id IS NOT NULL").isEmpty()


def test_csv_lines(spark, tmp_path):
    short, wrong, nothing = "2024-01-15T00:00:00Z,n1,g2", METRIC.format("g3", "high"), "noon,n1,g4,0,A10G,r1,1.0,1.0,1.0,1.0"
    path = folder(tmp_path, "metrics", [HEADER, METRIC.format("g1", "10.0"), short, wrong, nothing], "csv")
    rows, aside = outputs(spark, path, files.NODE_METRICS)
    assert aside == {short: True, wrong: True, nothing: False}
    assert sorted((r.gpu_id, r.gpu_util_pct) for r in rows.collect()) == [("g1", 10.0), ("g2", None), ("g3", None)]


def test_very_long_line_and_empty_input(spark, tmp_path):
    long = "x" * 2_000_000
    _, aside = outputs(spark, folder(tmp_path, "long", [json.dumps(JOB), long]), files.JOB_EVENTS)
    assert aside == {long: False}
    rows, aside = outputs(spark, folder(tmp_path, "empty", [""]), files.JOB_EVENTS)
    assert rows.isEmpty() and aside == {}


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    whole = json.dumps(JOB)
    folder(root, "job_events", [whole, whole[:30], "{", json.dumps(JOB | {"job_id": "b", "exit_code": "none"})])
    folder(root, "job_completions", [json.dumps({"job_id": "a", "ended_at": "2024-01-15T03:00:00Z", "duration_hours": 3.0})])
    folder(root, "inference_logs", [json.dumps({"request_id": "r1", "status_code": 200, "timestamp": "2024-01-15T00:00:00Z"}), "]"])
    folder(root, "node_metrics", [HEADER, METRIC.format("g1", "10.0")], "csv")
    return root


def test_batch_counts_what_it_sets_aside(spark, bronze, tmp_path):
    silver, aside = f"{tmp_path}/silver", f"{tmp_path}/aside"
    counts, bad = batch.build_checked_silver(spark, str(bronze), silver, aside, AS_OF)
    assert counts == {"jobs": 2, "inference": 1, "node_metrics": 1}
    assert bad == {"job_events": 3, "job_completions": 0, "inference_logs": 1, "node_metrics": 0}
    stored = tables.scan_table(spark, aside)
    assert stored.filter("kept").count() == 1 and stored.filter("input = 'inference_logs'").first().text == "]"
    assert stored.filter(F.col("file").endswith("part.json")).count() == 4
    # The unchecked load differs by the rows that stand for unreadable lines only.
    assert batch.build_silver(spark, str(bronze), f"{tmp_path}/plain", AS_OF) == counts | {"jobs": 3, "inference": 2}
    plain = tables.scan_table(spark, f"{tmp_path}/plain/jobs").filter("job_id IS NOT NULL")
    checked = tables.scan_table(spark, f"{silver}/jobs").select(*plain.columns)
    assert plain.exceptAll(checked).isEmpty() and checked.exceptAll(plain).isEmpty()

    # Once the lines are mended the next run empties the table.
    for name in ("job_events", "inference_logs"):
        file = bronze / name / "part.json"
        file.write_text(file.read_text().splitlines()[0] + "\n")
    _, bad = batch.build_checked_silver(spark, str(bronze), silver, aside, AS_OF, overwrite=False)
    assert set(bad.values()) == {0} and tables.scan_table(spark, aside).isEmpty()


def test_malformed_messages(spark):
    values = [b'{"request_id": "r1", "status_code": 200}', b"{not json", b"", None, b'{"request_id": "r2", "status_code": "ok"}']
    rows = [(i, 0, NOW, b"k", v) for i, v in enumerate(values)]
    got = ingest.malformed_messages(spark.createDataFrame(rows, schemas.STREAM_ENVELOPE)).orderBy("kafka_offset").collect()
    assert [(r.kafka_offset, r.kept) for r in got] == [(1, False), (2, False), (3, False), (4, True)]
    assert got[0].text == "{not json" and got[2].text is None


def test_matches_other_engine(spark):
    assert compare(spark, duck(DATA), DATA, "read_malformed") == ""
