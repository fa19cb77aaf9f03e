"""Edges that the tables do not have: strict JSON, rounding, stale gauges, writers, sessions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorloom import session
from sensorloom.functions.scalars import round_half_away
from sensorloom.operators import codec, metrics
from sensorloom.sources.points import telemetry_table
from sensorloom.sources.topics import read_topics

POINT = (
    "machine_id string, sensor_id string, metric_type string, value double, ts timestamp, "
    "arrived struct<at: timestamp, source: int, partition: int, offset: long>"
)
GOOD = '{"type":"DATA","payload":{"sensorId":"a"}}'


@pytest.mark.parametrize(
    "text, route",
    [
        (GOOD, "data"),
        (f" {GOOD} \n", "data"),
        (GOOD + " trailing", "malformed"),
        (GOOD + GOOD, "malformed"),
        (GOOD + "}", "malformed"),
        ("{'type':'DATA','payload':{}}", "malformed"),
        ('{"type":"LATENCY_MARKER","marker":{"ingress_ts_nano":NaN}}', "malformed"),
        ("", "malformed"),
        ("[]", "malformed"),
        ("null", "malformed"),
        (None, "malformed"),
        ('{"type":"OTHER"}', "unhandled"),
    ],
)
def test_envelopes_are_strict_json(spark, text, route):
    records = spark.createDataFrame([(text,)], "value string")
    assert codec.decode_and_route(records).first()["route"] == route


@pytest.mark.parametrize(
    "value, digits, rounded",
    [(4.9999999e-6, 5, 0.0), (0.5, 0, 1.0), (-0.5, 0, -1.0), (2.5, 0, 3.0), (1.234567, 5, 1.23457), (1.234565, 5, 1.23456), (0.0, 5, 0.0)],
)
def test_rounding_happens_once(spark, value, digits, rounded):
    row = spark.range(1).select(round_half_away(F.lit(value), digits).alias("r")).first()
    assert row["r"] == pytest.approx(rounded, abs=1e-12)


def test_silent_gauges_have_no_value(spark):
    now = dt.datetime(2024, 1, 31, tzinfo=dt.UTC)
    rows = [
        (now - dt.timedelta(seconds=10), "m", {"name": "a", "i": "1"}, 1.0),
        (now - dt.timedelta(days=30), "m", {"name": "a", "i": "2"}, 100.0),
        (now - dt.timedelta(seconds=5), "m", {"name": "", "i": "3"}, 7.0),
        (now - dt.timedelta(seconds=5), "m", {"i": "4"}, 7.0),
        (now - dt.timedelta(seconds=5), "other", {"name": "a"}, 7.0),
    ]
    samples = spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")
    found = metrics.latest_by(samples, "m", ["name"], F.lit(now)).collect()
    assert [tuple(r) for r in found] == [("a", 1.0)]


def test_writers_do_not_replace_each_other(spark, tmp_path):
    table = telemetry_table(str(tmp_path / "points"))
    day = dt.datetime(2024, 1, 1, 12, tzinfo=dt.UTC)

    def points(*seconds):
        rows = [("m", "s", "t", float(x), day + dt.timedelta(seconds=x), (day, 1, 0, x)) for x in seconds]
        return spark.createDataFrame(rows, POINT)

    table.append(points(1, 2), 0, "a")
    table.append(points(3), 0, "b")
    table.append(points(1, 2), 0, "a")  # a replay changes nothing
    assert sorted(r["value"] for r in table.scan(spark).collect()) == [1, 2, 3]
    table.compact(spark, F.lit(day + dt.timedelta(days=1)))
    assert sorted(r["value"] for r in table.read(spark).collect()) == [1, 2, 3]
    assert len(table.log.snapshot(spark).folders) == 1


def test_sessions_have_their_own_message_ids(spark):
    end = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = [("s", "m", end, end, 1.0, 1.0, 1.0, 0.0, 0.0, n) for n in (0, 1)]
    windows = spark.createDataFrame(
        rows,
        "sensor_id string, machine_id string, window_start timestamp, window_end timestamp, min_value double, "
        "mean_value double, max_value double, std_dev double, rate_of_change double, session_no long",
    )
    ids = codec.encode_windows(windows, F.lit(end)).select(F.get_json_object("value", "$.payload.messageId")).collect()
    assert len({r[0] for r in ids}) == 2


def test_workers_get_the_package(spark):
    shipped = [p for p in spark.sparkContext._python_includes if p.endswith("sensorloom.zip")]
    assert len(shipped) == 1 and session.ship_package(spark) is spark
    assert [p for p in spark.sparkContext._python_includes if p.endswith("sensorloom.zip")] == shipped


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_topics_need_a_place(spark):
    with pytest.raises(ValueError, match="servers="):
        read_topics(spark, ["a"])


@pytest.mark.parametrize("spread", [3, 20_000, 10**9, 2**62])
def test_ranks_are_found_by_ranges(spark, spread):
    import random

    rng = random.Random(spread)
    values = [rng.randrange(-spread, spread) for _ in range(3000)] + [spread // 2] * 500 + [None] * 5
    frame = spark.createDataFrame([(v,) for v in values], "x long").repartition(3)
    ordered = sorted(v for v in values if v is not None)
    ranks = {str(r): r for r in (0, 1, 1749, 1750, 3498, 3499, 3500, -1)}
    found, n = metrics.value_at_ranks(frame, "x", lambda n: ranks)
    assert n == 3500 and found == {k: ordered[r] for k, r in ranks.items() if 0 <= r < 3500}


def test_ranks_take_two_scans_and_no_values_give_none(spark):
    frame = spark.range(0, 200_000, 7, 4).select((F.col("id") * 37 % 20_000).alias("x"))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "ranks")
    found, n = metrics.value_at_ranks(frame, "x", lambda n: {"a": n // 2, "b": n - 1})
    scans = [status.getJobInfo(j) for j in status.getJobIdsForGroup("ranks")]
    spark.sparkContext.setJobGroup("", "")
    assert n == 28572 and set(found) == {"a", "b"} and len(scans) <= 4  # a scan is one or two jobs
    assert metrics.value_at_ranks(frame.where("x < 0"), "x", lambda n: {"a": 0}) == ({}, 0)
    none = spark.createDataFrame([], "latency_ms long, ok boolean")
    assert metrics.latency_percentiles(none).collect() == []
