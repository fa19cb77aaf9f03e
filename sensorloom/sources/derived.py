"""Sensor-shaped frames derived from the ``events`` table.

The rules are deterministic and each is restated as SQL in ``sensorloom.plans.oracle``. Durations
are scaled so that one second of the sensor protocol is one hour of ``events`` (about 67 rows per
user over 30 days): window 60 h, slide 30 h, lateness 15 h.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.constants import (
    COMMAND_STOP,
    READY,
    SENSOR_TYPES,
    SOURCE_LIFECYCLE,
    SOURCES,
    STOPPED,
    TOPIC_PRESSURE,
    TOPIC_PROCESSED,
    TOPIC_SIGNALS,
    TOPIC_TEMPERATURE,
    TYPE_DATA,
    TYPE_MARKER,
    WARM_UP,
)
from sensorloom.functions.arrival import arrival, source_rank
from sensorloom.operators.codec import processed_envelope

HOUR = 3600
WINDOW_S, SLIDE_S, LATENESS_S = 60 * HOUR, 30 * HOUR, 15 * HOUR
RANGE_S, BUCKET_S = 180 * HOUR, 120 * HOUR
NOW_TEXT = "2024-01-31 00:00:00"
EPOCH_TEXT = "2024-01-01 00:00:00"

#: Partitions of every topic. A sensor's records are dealt over all of them, with offsets that collide.
PARTITIONS = 4
#: Chunk of the arrival order for running values: five days of arrivals.
CHUNK_S = 5 * 24 * HOUR


def now() -> Column:
    return F.lit(NOW_TEXT).cast("timestamp")


def hours(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), count.cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/events.parquet")
    return frame.withColumn("ts", F.col("ts").cast("timestamp"))


def _dealt(event_id: Column) -> tuple[Column, Column]:
    """Partition and offset of the record of an event: each offset occurs in every partition."""
    return (event_id % PARTITIONS).cast("int"), F.call_function("div", event_id, F.lit(PARTITIONS))


def is_pressure() -> Column:
    return F.col("user_id") % 2 == 0


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as records. A file may be few row groups, which few tasks would read, so its rows are dealt over
    all cores before the costly columns are made of them."""
    cores = spark.sparkContext.defaultParallelism
    event_id, user_id = F.col("event_id"), F.col("user_id")
    recorded = F.col("ts") + hours((event_id * 7919) % 48)
    partition, offset = _dealt(event_id)
    topic = F.when(is_pressure(), TOPIC_PRESSURE).otherwise(TOPIC_TEMPERATURE)
    return events(spark, sf_dir).repartition(cores, "event_id").select(
        "event_id",
        "ts",
        user_id.cast("string").alias("sensor_id"),
        F.concat(F.lit("machine_"), (user_id % 10).cast("string")).alias("machine_id"),
        topic.alias("topic"),
        F.when(event_id % 100 == 0, F.lit(-999.99)).otherwise(F.col("value")).alias("value"),
        recorded.alias("recorded"),
        partition.alias("partition"),
        offset.alias("offset"),
        arrival(recorded, source_rank(topic), partition, offset),
        "user_id",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an already decoded reading:
    ``sensor_id, machine_id, ts, value, arrived`` (+ ``event_id, topic, recorded, partition, offset``)."""
    return _numbered(spark, sf_dir).drop("user_id")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw topic record (Kafka columns plus ``event_id``), faults included."""
    event_id = F.col("event_id")
    cold = F.col("topic") == TOPIC_TEMPERATURE
    measured = event_id % 89 != 5
    broken = event_id % 103 == 19
    payload = F.struct(
        F.concat(F.lit("m-"), event_id.cast("string")).alias("messageId"),
        F.when(event_id % 83 == 11, F.lit("")).otherwise(F.col("sensor_id")).alias("sensorId"),
        F.col("machine_id").alias("machineId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(measured & cold & ~broken, F.col("value")).alias("temperature_celsius"),
        F.when(measured & ~cold & ~broken, F.col("value")).alias("pressure_bar"),
    )
    bad_payload = F.struct(
        F.col("sensor_id").alias("sensorId"),
        F.when(cold, F.lit("n/a")).alias("temperature_celsius"),
        F.when(~cold, F.lit("n/a")).alias("pressure_bar"),
    )
    data = F.to_json(
        F.struct(
            F.lit(TYPE_DATA).alias("type"), F.when(~broken, payload).alias("payload")
        )
    )
    bad_data = F.to_json(
        F.struct(F.lit(TYPE_DATA).alias("type"), bad_payload.alias("payload"))
    )
    marker = F.to_json(
        F.struct(
            F.lit(TYPE_MARKER).alias("type"),
            F.struct((F.unix_micros("ts") * 1000).alias("ingress_ts_nano")).alias("marker"),
        )
    )
    value = (
        F.when(event_id % 97 == 13, F.lit('{"type":"DATA","payload":{"sensorId"'))
        .when(event_id % 40 == 7, marker)
        .when(event_id % 101 == 17, F.lit('{"type":"HEARTBEAT"}'))
        .when(broken, bad_data)
        .otherwise(data)
    )
    key = F.when((event_id % 97 != 13) & (event_id % 40 == 7), F.lit(TYPE_MARKER)).otherwise(
        F.col("sensor_id")
    )
    return _numbered(spark, sf_dir).select(
        key.alias("key"),
        value.alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("recorded").alias("timestamp"),
        "event_id",
    )


def timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, text, recorded``: instants written in good and bad ways."""
    e = F.col("event_id") % 7
    text = (
        F.when(e == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(e == 1, F.date_format("ts", "yyyy"))
        .when(e == 2, F.lit("not-a-time"))
        .when(e == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(e == 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(e == 5, F.lit(None).cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    return readings(spark, sf_dir).select("event_id", text.alias("text"), "recorded")


def sensor_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per sensor, none for ids ending in 9; drift limits are per second."""
    u = F.col("user_id")
    kind = F.when(u % 2 == 0, SENSOR_TYPES[1]).otherwise(SENSOR_TYPES[0])
    return (
        events(spark, sf_dir)
        .where(u % 10 != 9)
        .select("user_id")
        .distinct()
        .select(
            u.cast("string").alias("sensor_id"),
            kind.alias("type"),
            F.concat(F.lit("machine_"), (u % 10).cast("string")).alias("machine_id"),
            (20 + u % 7).cast("double").alias("min_threshold"),
            (75 + u % 11).cast("double").alias("max_threshold"),
            F.when(u % 6 == 0, F.lit(0.0))
            .otherwise((45 + u % 5).cast("double"))
            .alias("max_std_dev"),
            ((1.0 + (u % 4) * 0.5) / 3600.0).alias("max_drift"),
        )
    )


def config_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration requests as they reach the API: every event asks for its sensor, some with an
    unsupported type or an empty id; later requests replace earlier ones."""
    e, u = F.col("event_id"), F.col("user_id")
    kind = (
        F.when(e % 31 == 4, F.lit("HumiditySensor"))
        .when(is_pressure(), SENSOR_TYPES[1])
        .otherwise(SENSOR_TYPES[0])
    )
    return events(spark, sf_dir).select(
        e.alias("request_no"),
        F.when(e % 37 == 6, F.lit("")).otherwise(u.cast("string")).alias("sensor_id"),
        kind.alias("type"),
        F.concat(F.lit("machine_"), (u % 10).cast("string")).alias("machine_id"),
        F.col("value").alias("base_mean"),
        (F.col("value") / 100.0).alias("variance"),
        (1 + e % 3).cast("double").alias("interval_sec"),
        (F.col("value") * 0.7).alias("min_threshold"),
        (F.col("value") * 1.3).alias("max_threshold"),
        (1.5 + e % 4).cast("double").alias("max_std_dev"),
        (0.01 * (1 + e % 5)).cast("double").alias("max_drift"),
    )


def lifecycle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``message, machine_id, event_ts, stop_ts, arrived``: for some events a stop, a warm-up 20 h
    later and a restart 24 h later; the stop itself happened 10 h before it is announced. Some
    messages are malformed. They have a channel of their own, with offsets of its own."""
    e = F.col("event_id")
    steps = F.array(
        *[
            F.struct(F.lit(state).alias("state"), F.lit(after).alias("after"), F.lit(number).alias("number"))
            for number, (state, after) in enumerate(((STOPPED, 0), (WARM_UP, 20), (READY, 24)))
        ]
    )
    step = F.explode(steps).alias("step")
    frame = _numbered(spark, sf_dir).where(e % 29 == 3).select(
        "sensor_id", "machine_id", "ts", "event_id", step
    )
    event_ts = F.col("ts") + hours(F.col("step.after"))
    message = F.concat_ws(":", "sensor_id", "step.state")
    return frame.select(
        F.when(e % 23 == 5, F.concat(F.lit("plant:"), message)).otherwise(message).alias("message"),
        "machine_id",
        event_ts.alias("event_ts"),
        F.when(F.col("step.state") == STOPPED, F.col("ts") - hours(F.lit(10))).alias("stop_ts"),
        arrival(event_ts, SOURCES.index(SOURCE_LIFECYCLE), F.lit(0), e * 3 + F.col("step.number")),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the command topic: stops, other commands and malformed ones."""
    e = F.col("event_id")
    command = F.when(e % 3 == 0, F.lit("ModeNormal")).otherwise(F.lit(COMMAND_STOP))
    body = F.to_json(F.struct(F.col("sensor_id").alias("sensorId"), command.alias("command")))
    return _numbered(spark, sf_dir).select(
        F.col("sensor_id").alias("key"),
        F.when(e % 17 == 2, F.lit("{broken")).otherwise(body).alias("value"),
        F.lit(TOPIC_SIGNALS).alias("topic"),
        "partition",
        "offset",
        F.col("recorded").alias("timestamp"),
    )


def processed_records(spark: SparkSession, sf_dir: str, windows: DataFrame) -> DataFrame:
    """The processed topic: one record per window, emitted an hour after its end, some with a
    wrongly typed payload; markers, unhandled and malformed records of the raw topics in between."""
    emitted = F.col("window_end") + hours(F.lit(1))
    damaged = F.to_json(
        F.struct(
            F.lit(TYPE_DATA).alias("type"),
            F.struct(F.col("sensor_id").alias("sensorId"), F.lit("n/a").alias("media")).alias(
                "payload"
            ),
        )
    )
    keyed = windows.select(
        F.col("sensor_id").alias("key"),
        F.when(F.col("n_items") == 7, damaged)
        .otherwise(processed_envelope(emitted))
        .alias("value"),
        (F.col("sensor_id").cast("long") % PARTITIONS).cast("int").alias("partition"),
        F.unix_micros("window_end").alias("offset"),
        emitted.alias("timestamp"),
    )
    e = F.col("event_id")
    passing = raw_records(spark, sf_dir).where(
        (e % 97 == 13) | (e % 40 == 7) | (e % 101 == 17)
    )
    return keyed.unionByName(passing.select("key", "value", "partition", "offset", "timestamp")).withColumn(
        "topic", F.lit(TOPIC_PROCESSED)
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op_id, latency_ms, ok`` of load-test operations."""
    e = F.col("event_id")
    return events(spark, sf_dir).select(
        e.alias("op_id"), ((e * 37) % 20000).alias("latency_ms"), (e % 50 != 0).alias("ok")
    )


def sensor_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cnt, interval_sec``: sensors per reporting interval, one group without an interval."""
    interval = (F.col("user_id") % 5).cast("double") * 0.5
    return (
        events(spark, sf_dir)
        .select(interval.alias("interval_sec"), "user_id")
        .distinct()
        .groupBy("interval_sec")
        .agg(F.count("*").alias("cnt"))
    )
