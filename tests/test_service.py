"""Arrival order over sources, the lifecycle fold, commit log, stored configuration and the chained service."""

import datetime as dt
import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from sensorloom.functions.arrival import ARRIVED, arrival, arrival_us
from sensorloom.functions.running import Running, with_running
from sensorloom.operators import ingest, lifecycle
from sensorloom.operators.windows import WindowSpec
from sensorloom.plans.queries import SPEC, _events
from sensorloom.sources import derived
from sensorloom.sources.commits import CommitLog
from sensorloom.sources.config_table import ConfigTable
from sensorloom.sources.points import telemetry_table
from sensorloom.streaming import jobs
from sensorloom.streaming.pipeline import Pipeline

START = dt.datetime(2024, 6, 1, tzinfo=dt.UTC)  # months after the fixture's epoch
ORDER = "at timestamp, source int, partition int, offset long"
READING = f"sensor_id string, machine_id string, ts timestamp, value double, arrived struct<{ORDER}>"
EVENT = f"sensor_id string, state string, stop_ts timestamp, arrived struct<{ORDER}>"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


# ---------------------------------------------------------------- arrival order


def test_running_values_over_partitions_with_colliding_offsets(spark):
    rng = random.Random(0)
    rows = [("k", rng.randrange(100), (at(rng.randrange(40)), rng.randrange(3), p, o)) for p in range(4) for o in range(60)]
    frame = spark.createDataFrame(rows, f"key string, x long, arrived struct<{ORDER}>")
    got = with_running(frame, ["key"], ARRIVED, 7_000_000, arrival_us(), total=Running("sum", F.col("x")), top=Running("max", F.col("x"), inclusive=False))
    found = {r["arrived"]: (r["total"], r["top"]) for r in got.collect()}
    total, top = 0, None
    for _, x, order in sorted(rows, key=lambda r: r[2]):
        total += x
        key = next(k for k in found if (k["partition"], k["offset"]) == order[2:])
        assert found[key] == (total, top)
        top = x if top is None else max(top, x)


def test_a_stop_in_its_own_source_stops_later_readings(spark):
    readings = spark.createDataFrame(
        [("s", "m", at(i), float(i), (at(i), 1, i % 4, 900_000 + i // 4)) for i in range(6)], READING
    )
    events = spark.createDataFrame([("s", "STOPPED", at(1), (at(2.5), 0, 0, 12))], EVENT)
    kept = lifecycle.accepted(readings, events).collect()
    assert sorted(r["value"] for r in kept) == [0.0, 1.0, 2.0]


def simulated(seed, sensors=3, steps=160):
    """Readings over four partitions and lifecycle events of a channel of their own, with many ties in time."""
    rng, readings, events = random.Random(seed), [], []
    for s in range(sensors):
        for i in range(steps):
            arrived = at(rng.randrange(300))
            ts = arrived - dt.timedelta(seconds=rng.choice([0, 0, 3, 8, 20, 40]))
            readings.append((f"s{s}", "m", ts, float(rng.randrange(50)), (arrived, 1, rng.randrange(4), s * steps + i)))
        for i in range(14):
            when = at(rng.randrange(300))
            stop = rng.choice([when - dt.timedelta(seconds=rng.randrange(60)), None])
            events.append((f"s{s}", rng.choice(["STOPPED", "STOPPED", "READY", "WARM-UP"]), stop, (when, 0, 0, s * 14 + i)))
    return readings, events


def replayed(readings, events, spec):
    """One sensor's machine, record by record: windows, what each stop leaves, readings that count."""
    windows, stops, counted = [], [], []
    for sensor in sorted({r[0] for r in readings}):
        records = [(r[4], "reading", r) for r in readings if r[0] == sensor] + [(e[3], "event", e) for e in events if e[0] == sensor]
        known, stopped, session, top, last, buffer = False, False, 0, None, None, []
        for order, kind, row in sorted(records, key=lambda x: x[0]):
            if kind == "event":
                if not known:
                    continue
                if row[1] == "STOPPED":
                    stopped = True
                    stays = [b for b in buffer if row[2] is not None and b[0] <= row[2]]
                    stops.append((sensor, session, order[3], len(stays), len(buffer) - len(stays)))
                    buffer = stays
                elif row[1] == "READY":
                    stopped = False
                else:
                    session, top, last, buffer = session + 1, None, None, []
                continue
            known = True
            if stopped:
                continue
            counted.append((sensor, row[4][2], row[4][3], session))
            fresh = top is None or row[2] > top
            top = row[2] if fresh else top
            if (top - row[2]).total_seconds() > spec.lateness:
                continue
            buffer = [b for b in buffer if (top - b[2]).total_seconds() <= spec.size] + [(row[2], row[3], top)]
            if fresh and (last is None or (top - last).total_seconds() >= spec.slide):
                last = top
                values = [b[1] for b in buffer]
                windows.append((sensor, session, top, len(values), min(values), max(values), round(float(np.mean(values)), 6)))
    return sorted(windows), sorted(stops), sorted(counted)


@pytest.mark.parametrize("seed", range(3))
def test_batch_replays_the_machine(spark, seed):
    spec = WindowSpec(60, 30, 15, chunk=45)
    readings, events = simulated(seed)
    windows, stops, counted = replayed(readings, events, spec)
    rows, changes = spark.createDataFrame(readings, READING), spark.createDataFrame(events, EVENT)
    live = lifecycle.accepted(rows, changes, spec.chunk_us)
    assert sorted((r["sensor_id"], r["arrived"]["partition"], r["arrived"]["offset"], r["session_no"]) for r in live.collect()) == counted
    found = lifecycle.session_windows(rows, changes, spec).collect()
    utc = lambda t: t.astimezone(dt.UTC) if t.tzinfo else t.replace(tzinfo=dt.UTC)
    assert sorted(
        (r["sensor_id"], r["session_no"], utc(r["window_end"]), r["n_items"], r["min_value"], r["max_value"], round(r["mean_value"], 6))
        for r in found
    ) == windows
    purges = lifecycle.stop_purges(rows, changes, spec).collect()
    assert sorted((r["sensor_id"], r["session_no"], r["arrived"]["offset"], r["n_kept"], r["n_purged"]) for r in purges) == stops
    assert sum(s[4] for s in stops) > 20


def scans(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_lifecycle_plans_read_little(spark):
    readings, events = derived.readings(spark, SMALL), _events(spark, SMALL)
    assert scans(lifecycle.with_lifecycle(readings, events, SPEC.chunk_us)) <= 2
    purges = lifecycle.stop_purges(readings, events, SPEC)
    assert scans(purges) <= 3
    assert purges._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


# ---------------------------------------------------------------- commit log


POINT = f"machine_id string, sensor_id string, metric_type string, value double, ts timestamp, arrived struct<{ORDER}>"


def points(spark, *days):
    rows = [("m", "s", "t", float(d), START + dt.timedelta(days=d), (START, 1, 0, d)) for d in days]
    return spark.createDataFrame(rows, POINT)


def values(table, spark):
    return sorted(r["value"] for r in table.read(spark).collect())


def test_a_batch_that_breaks_between_days_is_never_seen(spark, tmp_path):
    table = telemetry_table(str(tmp_path / "points"))
    table.append(points(spark, 1), 0, "w")

    def breaks(folder):
        points(spark, 2).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(folder)
        raise RuntimeError("the executor is gone")

    with pytest.raises(RuntimeError, match="gone"):
        table.log.append(spark, "w", 1, breaks)
    assert values(table, spark) == [1]
    table.append(points(spark, 2, 3), 1, "w")
    assert values(table, spark) == [1, 2, 3]
    assert table.log.vacuum(spark) == 1 and values(table, spark) == [1, 2, 3]


def test_compaction_and_retention_leave_open_days_alone(spark, tmp_path):
    table = telemetry_table(str(tmp_path / "points"))
    for batch in range(3):
        table.append(points(spark, batch, 4, 5), batch, "w")
    live = lambda: {f: h["day"] for f, h in table.log.snapshot(spark).folders.items()}
    before = live()
    old = table.scan(spark)
    table.compact(spark, F.lit(START + dt.timedelta(days=5)))
    after = live()
    same_days = {f for f, day in before.items() if day in ("2024-06-01", "2024-06-06")}
    assert same_days <= after.keys() and sorted(after.values()).count("2024-06-05") == 1
    assert old.count() == 9 and values(table, spark) == [0, 1, 2, 4, 5]  # a reader keeps its snapshot
    table.retain(spark, F.lit(START + dt.timedelta(days=5)), 72)
    assert values(table, spark) == [2, 4, 5] and min(live().values()) == "2024-06-03"
    table.retain(spark, F.lit(START + dt.timedelta(days=5)), 72)
    assert table.log.vacuum(spark) > 0 and values(table, spark) == [2, 4, 5]


def test_two_writers_take_versions_in_turn(spark, tmp_path):
    log = CommitLog(str(tmp_path / "log"))
    asked = []

    def change(now):
        asked.append(now.version)
        if len(asked) == 1:  # another writer is faster
            log.commit(spark, lambda _: {"add": {"data/other": {}}})
        return {"add": {"data/mine": {}}, "writer": "w", "batch_id": 0}

    now = log.commit(spark, change)
    assert asked == [-1, 0] and set(now.folders) == {"data/other", "data/mine"} and now.has("w", 0)
    for i in range(1, 70):
        log.commit(spark, lambda s, i=i: {"add": {f"data/{i}": {}}, "writer": "w", "batch_id": i})
    now = log.snapshot(spark)
    assert len(now.folders) == 71 and now.batches["w"] == [70, []]
    assert log.replace(spark, ["data/absent"], None).version == now.version


def test_stored_configuration_keeps_a_readers_snapshot(spark, tmp_path):
    requests = derived.config_requests(spark, SMALL)
    table = ConfigTable(str(tmp_path / "config"), deltas=2)
    assert table.snapshot(spark).count() == 0
    table.register(requests.where("request_no % 5 = 0"), 0, "w")
    first = table.snapshot(spark)
    rows = sorted(map(tuple, first.collect()), key=repr)
    for batch in range(1, 5):
        table.register(requests.where(f"request_no % 5 = {batch}"), batch, "w")
        table.register(requests.where(f"request_no % 5 = {batch}"), batch, "w")
    assert sorted(map(tuple, first.collect()), key=repr) == rows
    kinds = [h["kind"] for h in table.log.snapshot(spark).folders.values()]
    assert kinds.count("base") == 1 and kinds.count("delta") <= 2
    newest = requests.where("sensor_id != '' and type != 'HumiditySensor'").groupBy("sensor_id").agg(F.max("request_no"))
    assert sorted(map(tuple, table.snapshot(spark).select("sensor_id", "request_no").collect())) == sorted(map(tuple, newest.collect()))


# ---------------------------------------------------------------- the service


def test_all_stages_run_at_once_and_go_on_after_a_stop(spark, tmp_path):
    from sensorloom.session import ROCKSDB_PROVIDER

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    raw, channel = str(tmp_path / "raw"), str(tmp_path / "channel")
    shape = derived.raw_records(spark, SMALL).drop("event_id")
    messages = lifecycle.parse_lifecycle(derived.lifecycle_messages(spark, SMALL))
    half = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    shape.where(half).write.parquet(raw)
    messages.write.parquet(channel)

    def service():
        return Pipeline(
            spark,
            str(tmp_path / "service"),
            raw=lambda: spark.readStream.schema(shape.schema).parquet(raw),
            lifecycle=lambda: spark.readStream.schema(messages.schema).parquet(channel),
            config=lambda: derived.sensor_config(spark, SMALL),
            now=derived.now(),
            emitted_at=F.col("window_end"),
            spec=SPEC,
        )

    service().drain()
    first = service().telemetry.read(spark).count()
    shape.where(~half).write.mode("append").parquet(raw)
    running = service().start("200 milliseconds")
    try:
        for name in ("ingest", "raw_points", "analyzer", "decision", "window_points"):
            running[name].processAllAvailable()
    finally:
        for query in running.values():
            query.stop()
    assert not any(q.exception() for q in running.values())
    done = service()
    done.drain()  # what was still on its way between two topics
    clean = derived.raw_records(spark, SMALL)
    want = ingest.clean_readings(clean).select("sensor_id", "machine_id", "event_time_text").distinct().count()
    assert first < done.telemetry.read(spark).count() == want
    assert done.metrics.read(spark).count() > 10 and done.alarms.read(spark).count() > 0
    reasons = {r[0] for r in done.rejects("ingest").read(spark, "reason string").distinct().collect()}
    assert reasons == {"malformed_envelope", "malformed_payload", "out_of_range"}
    assert done.health.histogram(spark).agg(F.max("total_n")).first()[0] > 0


def test_state_is_appended_over_many_batches(spark, tmp_path):
    """A backlog of many small micro-batches gives the machine's windows and leaves its buffer in the state."""
    from sensorloom.session import ROCKSDB_PROVIDER

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spec = WindowSpec(60, 30, 15)
    readings, events = simulated(7, sensors=2, steps=200)
    windows, _, _ = replayed(readings, events, spec)
    inputs = jobs.merge_inputs(spark.createDataFrame(readings, READING), spark.createDataFrame(events, EVENT))
    source, checkpoint, out = (str(tmp_path / n) for n in ("source", "checkpoint", "out"))
    schema, start = inputs.schema, int(START.timestamp()) * 1_000_000
    for number in range(10):
        part = inputs.where((F.col("at_us") >= start + number * 30_000_000) & (F.col("at_us") < start + (number + 1) * 30_000_000))
        part.coalesce(1).write.mode("append").parquet(source)
        rows = jobs.window_stream(spark.readStream.schema(schema).parquet(source), spec)
        writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    utc = lambda t: t.astimezone(dt.UTC) if t.tzinfo else t.replace(tzinfo=dt.UTC)
    assert sorted(
        (r["sensor_id"], r["session_no"], utc(r["window_end"]), r["n_items"], r["min_value"], r["max_value"], round(r["mean_value"], 6))
        for r in spark.read.parquet(out).collect()
    ) == windows
    state = {r["sensor_id"]: r for r in jobs.window_state(spark, checkpoint, spec).collect()}
    stored = spark.read.format("statestore").option("stateVarName", "buffer").load(checkpoint)
    held = {r[0]: r[1] for r in stored.groupBy("key.sensor_id").count().collect()}
    for sensor, row in state.items():
        assert row["n_items"] <= held.get(sensor, 0) <= 2 * row["n_items"] + 1
