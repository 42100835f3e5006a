import json

from conftest import NOW, ago
from fleetmeter import schemas
from fleetmeter.operators import enrich
from fleetmeter.sources import files, messages
from fleetmeter.streaming import health, ingest


def message(i, ts, **kw):
    return {"request_id": f"r{i}", "org_id": "o", "user_id": "u", "model_id": "m", "region": "e", "status_code": 200,
            "cache_hit": i % 2 == 0, "input_tokens": 1, "output_tokens": 2, "total_tokens": 3, "latency_ms": 1.5,
            "cost_usd": 0.25, "timestamp": ts, **kw}


def envelope(spark, values, start=0):
    rows = [(start + i, (start + i) % 2, NOW, b"k", v if isinstance(v, bytes) else json.dumps(v).encode())
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, schemas.STREAM_ENVELOPE).coalesce(1)


def test_malformed_message_keeps_its_position(spark):
    got = ingest.parse_stream_payload(envelope(spark, [message(1, "2024-01-01T00:00:00.123456"), b"{not json", b""])).collect()
    assert got[0].request_id == "r1" and got[0].cache_hit is False and got[0].timestamp.microsecond == 123456
    assert [r.kafka_offset for r in got] == [0, 1, 2]
    assert got[1].request_id is None and got[2].latency_ms is None and got[1].kafka_timestamp == NOW


def test_restart_appends_once_and_keeps_late_rows(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def drain():
        q = ingest.inference_stream_ingest(ingest.file_stream_source(spark, source, max_files=1), table, checkpoint,
                                           NOW, drain=True)
        q.awaitTermination()
        return spark.read.parquet(table)

    envelope(spark, [message(i, "2024-01-10T12:00:00") for i in range(3)]).write.parquet(source)
    assert drain().count() == 3
    assert drain().count() == 3
    late = [message(3, "1999-01-01T23:00:00"), b"broken", message(4, "2024-01-11T01:00:00")]
    envelope(spark, late, 3).write.mode("append").parquet(source)
    got = drain()
    assert got.count() == 6
    late_row = got.filter("request_id = 'r3'").first()
    assert (str(late_row.log_date), late_row.log_hour, late_row._stream_ingested_at) == ("1999-01-01", 23, NOW)
    assert got.filter("log_date IS NULL").count() == 1
    # The batch reads the stream's table like its own files.
    silver = enrich.silver_inference(got.filter("request_id IS NOT NULL"), NOW)
    assert silver.count() == 5 and dict(silver.dtypes)["cache_hit"] == "boolean"


def test_kafka_settings():
    options = ingest.kafka_options("h:1")
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "inference-api-logs", "startingOffsets": "earliest",
                       "failOnDataLoss": "true"}
    assert ingest.kafka_options("h:1", **ingest.SMALL_DEPLOYMENT) == options | {
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10000"}
    assert ingest.TRIGGER_INTERVAL == "30 seconds"


def test_watermark_is_declared(spark, tmp_path):
    path = str(tmp_path / "in")
    envelope(spark, [message(1, "2024-01-01T00:00:00")]).write.parquet(path)
    plan = ingest.inference_stream(ingest.file_stream_source(spark, path))._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan and "10 minutes" in plan


def test_messages_round_trip(spark, tmp_path):
    rows = [("a", NOW.replace(microsecond=123456), None), (None, None, 2.5)]
    df = spark.createDataFrame(rows, "job_id string, started_at timestamp, x double")
    got = [(r.key, json.loads(r.value)) for r in messages.to_kafka_records(df, "job_id").collect()]
    assert got == [("a", {"job_id": "a", "started_at": "2024-01-15T12:00:00.123456", "x": None}),
                   (None, {"job_id": None, "started_at": None, "x": 2.5})]
    assert messages.TOPIC_KEYS["inference-api-logs"] == "request_id"


def test_raw_readers_take_malformed_lines(spark, tmp_path):
    path = tmp_path / "jobs"
    path.mkdir()
    (path / "a.jsonl").write_text(
        '{"job_id": "j", "gpu_count": 4, "started_at": "2024-01-02T03:04:05.678901", "is_late_arrival": true}\n'
        "not json\n"
        '{"job_id": "k", "gpu_count": "many", "is_late_arrival": false}\n')
    got = files.read_job_events(spark, str(path)).collect()
    assert [(r.job_id, r.gpu_count, r.is_late_arrival) for r in got] == [
        ("j", 4, "true"), (None, None, None), ("k", None, "false")]
    assert got[0].started_at.microsecond == 678901
    csv = tmp_path / "m.csv"
    csv.write_text("timestamp,node_id,gpu_id,gpu_index,gpu_type,rack_id,gpu_util_pct,memory_util_pct,temp_celsius,power_watts\n"
                   "2024-01-02T03:00:00,n,g,1,H100,r,50.5,x,70,300\n")
    row = files.read_node_metrics(spark, str(csv)).first()
    assert (row.gpu_util_pct, row.memory_util_pct, row.timestamp.hour) == (50.5, None, 3)


def test_freshness(spark):
    table = spark.createDataFrame([(ago(minutes=30),), (ago(minutes=12),)], "_stream_ingested_at timestamp")
    assert tuple(health.stream_freshness(table, NOW).first()) == (ago(minutes=12), 12.0, True)
    assert health.stream_freshness(table, ago(minutes=5)).first().is_stale is False
    assert tuple(health.stream_freshness(table.limit(0), NOW).first()) == (None, None, None)


def test_lag(spark):
    source = envelope(spark, [message(i, "2024-01-01T00:00:00") for i in range(10)])
    read = ingest.parse_stream_payload(source.filter("partition = 0 AND offset < 5"))
    end, committed = health.end_offsets(source), health.committed_offsets(read)
    assert {r.partition: r.end_offset for r in end.collect()} == {0: 9, 1: 10}
    assert {r.partition: r.committed_offset for r in committed.collect()} == {0: 5}
    assert tuple(health.consumer_lag(end, committed).first()) == (2, 14, False)
    assert health.consumer_lag(end, committed, max_lag=13).first().is_lagging is True
    assert tuple(health.consumer_lag(end.limit(0), committed).first()) == (0, 0, False)


def test_messages_delivered_again_are_left_out_across_restarts(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def deliver(values, start, mode="append", as_of=NOW):
        envelope(spark, values, start).write.mode(mode).parquet(source)
        stream = ingest.file_stream_source(spark, source, max_files=1)
        ingest.inference_stream_ingest(stream, table, checkpoint, as_of, drain=True, unique_within="1 hour").awaitTermination()
        return sorted((r.request_id or "", r.kafka_offset) for r in spark.read.parquet(table).collect())

    first = [message(1, "2024-01-10T12:00:00"), message(2, "2024-01-10T12:00:00"), message(1, "2024-01-10T12:00:00"), b"bad"]
    got = deliver(first, 0)
    assert [r for r, _ in got] == ["", "r1", "r2"]
    # A new start of the query: two come again, one is years late, one has no id either.
    second = [message(2, "2024-01-10T12:00:00"), message(3, "1999-01-01T00:00:00"), b"bad", message(1, "2024-01-10T12:00:00")]
    got = deliver(second, 10)
    assert [r for r, _ in got] == ["", "", "r1", "r2", "r3"] and ("", 12) in got and ("r3", 11) in got
    # Long after, an id is new again. One batch moves the watermark, the next one finds the state gone.
    deliver([message(4, "2024-01-10T12:00:00")], 20, as_of=NOW.replace(day=20))
    got = deliver([message(2, "2024-01-10T12:00:00")], 30, as_of=NOW.replace(day=20))
    assert [r for r, _ in got] == ["", "", "r1", "r2", "r2", "r3", "r4"]


def test_progress_gives_the_reports_of_a_full_scan(spark, tmp_path):
    source, table, checkpoint, progress, marks = (str(tmp_path / n) for n in ("in", "out", "cp", "progress", "marks"))
    assert tuple(health.stream_freshness(health.read_progress(spark, progress), NOW).first()) == (None, None, None)
    everything = envelope(spark, [message(i, "2024-01-10T12:00:00") for i in range(40)])
    for n, start in enumerate((0, 12, 24)):
        everything.filter(f"offset >= {start} AND offset < {start + 12}").write.mode("append").parquet(source)
        ingest.inference_stream_ingest(ingest.file_stream_source(spark, source, max_files=1), table, checkpoint,
                                       ago(minutes=30 - 10 * n), drain=True).awaitTermination()
        query = health.track_progress(spark, table, progress, marks)
        query.awaitTermination()
        assert sum(p.numInputRows for p in query.recentProgress) == 12  # only what was added
        scanned, tracked = spark.read.parquet(table), health.read_progress(spark, progress)
        assert tracked.count() == 2 and len(tracked.inputFiles()) == 1
        assert health.stream_freshness(scanned, NOW).first() == health.stream_freshness(tracked, NOW).first()
        end = health.end_offsets(everything)
        lags = [health.consumer_lag(end, health.committed_offsets(t)).first() for t in (scanned, tracked)]
        assert lags[0] == lags[1] and lags[0].total_lag > 0
