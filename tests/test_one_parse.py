"""The stages parse a record once; what two parses would make of odd texts stays."""

from conftest import SMALL
from oracle_check import connect, differences
from pyspark.sql import functions as F

from sensorloom.constants import TOPIC_CLEANED, TOPIC_PRESSURE, TOPIC_PROCESSED, TOPIC_TEMPERATURE
from sensorloom.operators import codec, ingest
from sensorloom.plans import streams
from sensorloom.plans.oracle import ORACLE
from sensorloom.schemas import KAFKA_FRAME
from sensorloom.sources import derived
from sensorloom.sources.topics import TopicSink
from sensorloom.streaming import jobs

PAYLOADS = [
    '{"sensorId":"1","machineId":"m","timestamp":"2024-01-01T00:00:00Z","temperature_celsius":21.5,"pressure_bar":3}',
    '{"sensorId":"1","temperature_celsius":"21.5"}',
    '{"sensorId":"1","pressure_bar":"n/a","temperature_celsius":2}',
    '{"sensorId":"1","temperature_celsius":1e400,"pressure_bar":-1e400}',
    '{"sensorId":"1","temperature_celsius":1e-400,"media":1.10,"std-dev":-0.0}',
    '{"sensorId":1.10,"machineId":{"a": 1.0, "b":[1,  2e5]},"timestamp":true,"messageId":[]}',
    '{"sensorId":"","sensorId":"2","media":1,"media":2}',
    '{"sensorId":null,"temperature_celsius":null,"media":null}',
    '{"sensorId":"1","media":NaN}',
    '{"sensorId":"1","media":"NaN","temperature_celsius":"Infinity"}',
    "{'sensorId':'1'}",
    '{"sensorId":"1","media":"n/a"}',
    '{"sensorId":"1","other":{"deep":[{}]},"media":3,"windowStart":7}',
    '{"sensorId":"\\u00e9\\n\\"","media":12345678901234567890,"pressure_bar":0.1234567890123456789}',
    '{"sensorId":"1"',
    '{"_corrupt":"x","__end_of_record__":3,"value":1}',
    '{"SENSORID":"1","Media":1}',
    "{}", "[]", "[{}]", '[{"sensorId":"1"}]', '""', '" "', "null", '"null"', "7", "true", '"text"', '"{}"',
    '"{\\"sensorId\\":\\"9\\",\\"media\\":4,\\"temperature_celsius\\":5}"',
]
ENVELOPES = [
    None, "", " ", "null", "{}", "[]", '""', "7", "x", '{"type":"DATA"}', '{"type":"MARKER"}', '{"type":null,"payload":{}}',
    '{"type":"MARKER","marker":{"ingress_ts_nano":5}}', '{"type":"MARKER","marker":{}}', '{"type":"MARKER","marker":null}',
    '{"type":"MARKER","marker":{"ingress_ts_nano":"5"}}', '{"type":"MARKER","marker":3}', '{"type":7,"payload":{}}',
    '{"type":"DATA","payload":{}} x', '{"type":"DATA","payload":{}},"a":{"b":1', '{"type":"DATA","payload":{}}}',
    '{"type":"DATA","payload":{"media":1},"payload":null}', '{"type":"DATA","payload":"x","payload":{"media":1}}',
    '{"type":"DATA","payload":{"media":1},"payload":{"sensorId":"3"}}', '{"type":"HEARTBEAT"}',
    '{"type":"MARKER","marker":{"ingress_ts_nano":5},"payload":{"media":"n/a"}}',
    '{"type":"MARKER","marker":{"ingress_ts_nano":"a"},"payload":{"media":1}}', '[{"type":"DATA","payload":{}}]',
]
TEXTS = ENVELOPES + [f'{{"type":"{kind}","payload":{p}}}' for p in PAYLOADS for kind in ("DATA", "MARKER")] + [
    f' {{ "payload" : {p} , "type" : "DATA", "marker":{{"ingress_ts_nano":1}} }} ' for p in PAYLOADS
]


def odd_records(spark, *topics):
    rows = [
        (f"k{n}", text, topic, n % 4, n, None) for topic in topics for n, text in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, KAFKA_FRAME).withColumn("timestamp", F.timestamp_seconds("offset"))


def same(found, expected):
    names = [c for c in expected.columns if c != "payload"]
    assert set(found.columns) == set(names)
    rows = [sorted(map(repr, frame.select(*names).collect())) for frame in (found, expected)]
    assert len(rows[1]) > len(TEXTS) / 2
    for one, two in zip(*rows, strict=True):
        assert one == two


def test_readings_of_odd_texts_are_those_of_two_parses(spark):
    records = odd_records(spark, TOPIC_TEMPERATURE, TOPIC_PRESSURE, "other")
    same(codec.decode_readings(records), codec.decode_typed_payload(codec.decode_and_route(records)))


def test_windows_of_odd_texts_are_those_of_two_parses(spark):
    records, now = odd_records(spark, TOPIC_PROCESSED), derived.now()
    same(codec.decode_windows(records, now), codec.decode_processed_all(codec.decode_and_route(records), now))


def test_one_generator_parses_a_record(spark):
    plan = codec.decode_readings(odd_records(spark, TOPIC_TEMPERATURE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1


def test_judged_records_are_the_cleaned_and_the_rejected(spark):
    typed = codec.decode_readings(odd_records(spark, TOPIC_TEMPERATURE, TOPIC_PRESSURE))
    judged = ingest.judged_of(typed)
    same(ingest.passed(judged), ingest.cleaned_of(typed).select(*KAFKA_FRAME.names))
    rows = [sorted(map(repr, f.collect())) for f in (ingest.rejected(judged), ingest.rejects_of(typed))]
    assert rows[0] == rows[1] and rows[0]


def test_a_batch_holds_one_text_of_a_record(spark, monkeypatch, tmp_path):
    held = []
    frame = type(spark.range(1))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: held.append(self.columns) or persist(self, *level))
    out = [str(tmp_path / name) for name in ("cleaned", "rejects", "counters")]
    body = jobs.ingest_body(TopicSink(TOPIC_CLEANED, out[0]), *map(jobs.OutputFolder, out[1:]), "w")
    body(odd_records(spark, TOPIC_TEMPERATURE), 0)
    assert len(held) == 1 and not {"payload", "message_id", "event_time_text", "measure"} & set(held[0])


def test_slices_are_written_once_and_whole(spark, monkeypatch):
    names = []
    written = streams.written
    monkeypatch.setattr(streams, "written", lambda frame, name: names.append(name) or written(frame, name))
    found = streams.stream_rejects(spark, SMALL)
    assert "records" not in names
    assert differences(found, connect(SMALL), ORACLE["stream_rejects"]) == []
