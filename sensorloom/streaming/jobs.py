"""Streaming stages. Each takes and returns streaming DataFrames or is a ``foreachBatch`` body.

Restart, state and offsets are the checkpoint's business: a micro-batch commits both together. The
``foreachBatch`` bodies are idempotent per writer and batch id, so a replayed batch changes nothing.
``writer`` names the checkpoint: a stage that starts over with a fresh one needs a new name, or its
first batches would replace those of the old one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions.arrival import ARRIVED, ORDER as ARRIVAL, arrival_us, record_arrival
from sensorloom.operators import codec, decide, ingest, lifecycle, metrics
from sensorloom.operators.windows import WindowSpec
from sensorloom.sources.config_table import ConfigTable
from sensorloom.sources.points import PointTable
from sensorloom.sources.topics import TopicSink
from sensorloom.streaming.processor import ORDER, OUTPUT, SlidingWindowProcessor

BatchBody = Callable[[DataFrame, int], None]


def merge_inputs(items: DataFrame, events: DataFrame) -> DataFrame:
    """Window items and lifecycle events as one stream on one arrival order."""
    order = [arrival_us().alias("at_us"), *[F.col(f"{ARRIVED}.{f}").alias(f) for f in ORDER[1:]]]
    readings = items.select(
        "sensor_id",
        "machine_id",
        F.unix_micros("ts").alias("ts_us"),
        "value",
        *order,
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("long").alias("stop_us"),
    )
    changes = events.select(
        "sensor_id",
        F.lit(None).cast("string").alias("machine_id"),
        F.lit(None).cast("long").alias("ts_us"),
        F.lit(None).cast("double").alias("value"),
        *order,
        "state",
        F.unix_micros("stop_ts").alias("stop_us"),
    )
    return readings.unionByName(changes)


def window_stream(
    inputs: DataFrame, spec: WindowSpec = WindowSpec(), idle_ttl_ms: int | None = None
) -> DataFrame:
    """Merged inputs to window rows. No query-wide watermark: each sensor has its own."""
    rows = inputs.groupBy("sensor_id").transformWithState(
        statefulProcessor=SlidingWindowProcessor(spec, idle_ttl_ms),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None" if idle_ttl_ms is None else "ProcessingTime",
    )
    return rows.withColumns(
        {
            "window_start": F.timestamp_micros("window_start_us"),
            "window_end": F.timestamp_micros("window_end_us"),
        }
    ).drop("window_start_us", "window_end_us")


def window_state(spark: SparkSession, checkpoint: str, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """The state of ``window_stream`` as its last committed batch left it, one row per sensor: whether it is
    stopped, its session, event clock and last evaluation, and what its buffer holds."""

    def read(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    sensor = F.col("key.sensor_id").alias("sensor_id")
    clocks = read("clock").select(sensor, "value.*")
    items = read("buffer").select(sensor, F.col("list_element").alias("item"))
    live = items.join(clocks.select("sensor_id", "max_us"), "sensor_id")
    held = live.where(F.col("item.max_us") >= F.col("max_us") - F.lit(spec.size_us))
    held = held.groupBy("sensor_id").agg(
        F.count("*").alias("n_items"),
        F.min("item.ts_us").alias("first_us"),
        F.max("item.ts_us").alias("last_item_us"),
        F.sum("item.value").alias("value_sum"),
    )
    return clocks.join(held, "sensor_id", "left").select(
        "sensor_id",
        "session_no",
        "stopped",
        "max_us",
        "last_us",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "first_us",
        "last_item_us",
        F.coalesce("value_sum", F.lit(0.0)).alias("value_sum"),
    )


def processed_stream(
    cleaned: DataFrame,
    lifecycle_events: DataFrame,
    now: Column,
    emitted_at: Column,
    spec: WindowSpec = WindowSpec(),
    idle_ttl_ms: int | None = None,
) -> DataFrame:
    """The analyzer stage: the cleaned topic and parsed lifecycle events to records of the processed topic.

    Windows of running sensors are encoded, keyed by sensor; latency markers pass unchanged. ``now`` stands in
    for unreadable event times, ``emitted_at`` stamps a window's record (an expression over the window's columns,
    or the clock).
    """
    routed = codec.decode_and_route(cleaned)
    items = codec.to_window_items(codec.decode_telemetry(routed), now)
    windows = window_stream(merge_inputs(items, lifecycle_events), spec, idle_ttl_ms)
    windows = windows.withColumn("emitted", emitted_at)
    return codec.window_records(windows, F.col("emitted")).unionByName(codec.marker_records(routed))


@dataclass(frozen=True)
class OutputFolder:
    """Parquet output addressed by writer and batch: the same pair again replaces its own files."""

    path: str

    def write(self, frame: DataFrame, batch_id: int, writer: str) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/writer={writer}/batch_id={batch_id}")

    def read(self, spark: SparkSession, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(self.path)


def telemetry_sink(table: PointTable, now: Column, writer: str) -> BatchBody:
    """Cleaned-topic batches into the raw point table."""

    def body(batch: DataFrame, batch_id: int) -> None:
        telemetry = codec.decode_telemetry(codec.decode_and_route(batch))
        table.append(codec.to_telemetry_points(telemetry, now), batch_id, writer)

    return body


def metrics_sink(
    table: PointTable, counters: OutputFolder, now: Column, writer: str
) -> BatchBody:
    """Processed-topic batches into the metrics point table, with the stage's counters."""

    def body(batch: DataFrame, batch_id: int) -> None:
        records = codec.decode_windows(batch, now).persist()
        try:
            rows = records.where("payload_ok").select(
                *table.tags,
                *table.fields,
                F.col("emit_ts").alias("ts"),
                record_arrival(),
            )
            table.append(rows, batch_id, writer)
            outcomes = metrics.count_outcomes(decide.sink_outcomes(records))
            counters.write(outcomes, batch_id, writer)
        finally:
            records.unpersist()

    return body


def ingest_body(cleaned: TopicSink, rejects: OutputFolder, counters: OutputFolder, writer: str) -> BatchBody:
    """Raw-topic batches to the cleaned topic, the rejected records with their reason, and counts of all outcomes.

    A batch is parsed once, and what is held of a record is one text and its outcome.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        judged = ingest.judged_of(codec.decode_readings(batch)).persist()
        try:
            cleaned.write(ingest.passed(judged), batch_id, writer)
            rejects.write(ingest.rejected(judged), batch_id, writer)
            counters.write(judged.groupBy("topic", "outcome").agg(F.count("*").alias("n")), batch_id, writer)
        finally:
            judged.unpersist()

    return body


def config_body(table: ConfigTable, writer: str) -> BatchBody:
    """Registration requests to the stored configuration."""

    def body(batch: DataFrame, batch_id: int) -> None:
        table.register(batch, batch_id, writer)

    return body


@dataclass(frozen=True)
class StageHealth:
    """Where a stage leaves its lag gauges and the latency histogram of its markers, per batch."""

    lags: OutputFolder
    latencies: OutputFolder

    def last_lags(self, spark: SparkSession) -> DataFrame:
        """The last lag set per sensor."""
        schema = T.StructType().add("sensor_id", "string").add(ARRIVED, ARRIVAL).add("lag_seconds", "double")
        rows = self.lags.read(spark, schema)
        return metrics.last_lag(rows, F.col("lag_seconds"))

    def histogram(self, spark: SparkSession) -> DataFrame:
        """Cumulative bucket counts of all batches: ``le, n, total_seconds, total_n``."""
        rows = self.latencies.read(spark, "le string, n long, total_seconds double, total_n long")
        return rows.groupBy("le").agg(*[F.sum(c).alias(c) for c in ("n", "total_seconds", "total_n")])


def decision_body(
    load_config: Callable[[], DataFrame],
    alarms: OutputFolder | TopicSink,
    counters: OutputFolder,
    now: Column,
    writer: str,
    compat: str = "intended",
    health: StageHealth | None = None,
    rejects: OutputFolder | None = None,
) -> BatchBody:
    """Processed-topic batches to alarm records, counters and, if given, rejects and the stage's health.

    ``load_config`` runs once per batch, so a batch sees the configuration of its own time. A batch is parsed
    and joined with it once, and all outputs come from that; what is held of a record is only what they need.
    """
    place = ("partition", "offset", "timestamp")
    verdict = ("route", "payload_ok", "has_config", "rule_code", "reason")
    needed = ["sensor_id", "key", "value", "topic", *place, *verdict]
    if health is not None:
        needed.append("ingress_ts_nano")

    def body(batch: DataFrame, batch_id: int) -> None:
        decoded = codec.decode_windows(batch, now)
        sensor = F.when(F.col("payload_ok"), F.col("sensor_id"))
        records = decide.with_config(decoded.withColumn("sensor_id", sensor), load_config())
        records = records.withColumns(
            {
                "rule_code": F.when(F.col("payload_ok") & F.col("has_config"), decide.rule_code(compat)),
                "reason": decide.reject_reason(),
            }
        )
        text = F.when(F.col("reason").isNotNull(), F.col("value"))
        records = records.withColumn("value", text).select(*needed).persist()
        try:
            commands = decide.encode_alarms(
                records.where("rule_code is not null").select(
                    "sensor_id",
                    F.lit(decide.COMMAND_STOP).alias("command"),
                    "partition",
                    "offset",
                    "timestamp",
                )
            )
            alarms.write(commands, batch_id, writer)
            counters.write(metrics.count_outcomes(decide.enriched_outcomes(records)), batch_id, writer)
            if rejects is not None:
                rejects.write(decide.rejected(records), batch_id, writer)
            if health is not None:
                lag = metrics.record_lag(now, F.col("timestamp"))
                health.lags.write(
                    records.where("payload_ok").select("sensor_id", record_arrival(), lag.alias("lag_seconds")),
                    batch_id,
                    writer,
                )
                passed = records.where(F.col("route") == codec.MARKER)
                ms = codec.marker_latency_ms(F.col("ingress_ts_nano"), F.unix_micros(now) * 1000)
                seconds = passed.select((ms / 1000.0).alias("seconds"))
                health.latencies.write(
                    metrics.latency_histogram(seconds, "seconds"), batch_id, writer
                )
        finally:
            records.unpersist()

    return body


def status_body(feed: OutputFolder, writer: str) -> BatchBody:
    """Lifecycle batches to the change feed; the current status is ``current_status`` of it."""

    def body(batch: DataFrame, batch_id: int) -> None:
        events = lifecycle.parse_lifecycle(batch)
        feed.write(
            events.select("sensor_id", "machine_id", "state", ARRIVED), batch_id, writer
        )

    return body


def current_status(spark: SparkSession, feed: OutputFolder) -> DataFrame:
    """What a dashboard shows before it follows the feed: the last status per sensor."""
    schema = T.StructType().add("sensor_id", "string").add("machine_id", "string").add("state", "string")
    rows = feed.read(spark, schema.add(ARRIVED, ARRIVAL))
    return lifecycle.latest_status(rows)
