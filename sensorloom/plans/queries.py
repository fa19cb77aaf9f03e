"""Every operator as a runnable query over the given tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole tables. Time columns leave as zone-free timestamps and floating-point
aggregates are rounded, so that any engine can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.constants import MICROS, RETENTION_HOURS, SOURCES, TOPIC_PRESSURE, TOPIC_PROCESSED, TOPIC_TEMPERATURE
from sensorloom.functions.arrival import ARRIVED, arrival, record_arrival, spread
from sensorloom.functions.scalars import round_half_away, stable_id
from sensorloom.functions.times import bucket_start, clock_text, parse_rfc3339
from sensorloom.operators import codec, decide, ingest, lifecycle, metrics, points, registry
from sensorloom.operators.windows import (
    WindowSpec,
    evaluations,
    sliding_windows,
    statistics,
    with_event_clock,
)
from sensorloom.schemas import STATS
from sensorloom.session import fresh_path, ship_package, written
from sensorloom.sources import derived, samples
from sensorloom.sources.points import metrics_table, telemetry_table
from sensorloom.sources.topics import read_topics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEC = WindowSpec(derived.WINDOW_S, derived.SLIDE_S, derived.LATENESS_S, derived.CHUNK_S)
DIGITS = 6
RATE_DIGITS = 9


def query(build: Query) -> Query:
    """Register under the function's own name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        frame = build(spark, sf_dir)
        return frame.select(
            *[
                F.col(field.name).cast("timestamp_ntz").alias(field.name)
                if field.dataType.typeName() == "timestamp"
                else F.col(field.name)
                for field in frame.schema
            ]
        )

    QUERIES[build.__name__] = run
    return run


def rounded(frame: DataFrame, *names: str, digits: int = DIGITS) -> DataFrame:
    return frame.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


def _rounded_stats(frame: DataFrame) -> DataFrame:
    frame = rounded(frame, *[name for name in STATS if name != "rate_of_change"])
    return rounded(frame, "rate_of_change", digits=RATE_DIGITS)


def _raw(spark, sf_dir):
    return derived.raw_records(spark, sf_dir)


def _routed(spark, sf_dir):
    return codec.decode_and_route(_raw(spark, sf_dir))


def _typed(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    return codec.decode_typed_payload(routed.where(F.col("route") == codec.DATA))


def _telemetry(spark, sf_dir):
    return codec.decode_telemetry(_routed(spark, sf_dir))


def _windows(spark, sf_dir):
    return sliding_windows(derived.readings(spark, sf_dir), spec=SPEC)


def _events(spark, sf_dir):
    return lifecycle.parse_lifecycle(derived.lifecycle_messages(spark, sf_dir))


def _clocked(spark, sf_dir):
    return with_event_clock(derived.readings(spark, sf_dir), ["sensor_id"], SPEC)


def _processed(spark, sf_dir):
    """The processed topic, written once: several branches of a stage read it."""
    frame = derived.processed_records(spark, sf_dir, _windows(spark, sf_dir))
    return codec.decode_and_route(written(frame, "processed"))


_fresh = fresh_path


# ---------------------------------------------------------------- sources and sinks


@query
def src_raw_scan(spark, sf_dir):
    path = _fresh(spark, "topics")
    _raw(spark, sf_dir).drop("event_id").write.parquet(path)
    records = read_topics(
        spark, [TOPIC_TEMPERATURE, TOPIC_PRESSURE], path=path, streaming=False
    )
    return records.select("key", "topic", "partition", "offset", "timestamp")


@query
def union_sensor_streams(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("key", "topic", "offset")
    warm, tight = (raw.where(F.col("topic") == t) for t in (TOPIC_TEMPERATURE, TOPIC_PRESSURE))
    return warm.unionByName(tight)


@query
def signals_stop_commands(spark, sf_dir):
    return decide.stop_commands(derived.signals(spark, sf_dir))


@query
def signals_compacted(spark, sf_dir):
    return spread(decide.compacted(derived.signals(spark, sf_dir)))


def _hourly_points(spark, sf_dir):
    rows = codec.to_telemetry_points(_telemetry(spark, sf_dir), derived.now())
    return rows.withColumn("ts", F.date_trunc("hour", "ts"))


@query
def sink_telemetry_points(spark, sf_dir):
    table = telemetry_table(_fresh(spark, "telemetry"))
    rows = _hourly_points(spark, sf_dir)
    later = F.col("arrived.offset") % 2 == 0
    table.append(rows.where(later), 1, "sink")
    table.append(rows.where(~later), 0, "sink")
    table.append(rows.where(later), 1, "sink")
    return spread(table.read(spark))


@query
def sink_two_writers(spark, sf_dir):
    """Two writers with the same batch ids, a replayed batch, a writer that starts over with a fresh
    checkpoint, and the closed days compacted: no point is lost."""
    table = telemetry_table(_fresh(spark, "telemetry"))
    rows = written(_hourly_points(spark, sf_dir), "points")
    part = F.pmod(F.xxhash64("sensor_id", "arrived"), F.lit(4))
    table.append(rows.where(part == 0), 0, "north")
    table.append(rows.where(part == 1), 0, "south")
    table.append(rows.where(part == 2), 1, "north")
    table.append(rows.where(part == 0), 0, "north")
    table.append(rows.where(part == 3), 0, "north-restarted")
    middle = F.lit("2024-01-16").cast("timestamp")
    table.compact(spark, middle)
    return spread(table.read(spark))


@query
def table_retained(spark, sf_dir):
    """A point table in place: closed days compacted, days older than the retention of its topic dropped, and what
    neither names deleted from disk. A late batch of a closed day is read along with the compacted one."""
    table = telemetry_table(_fresh(spark, "telemetry"))
    rows = written(_hourly_points(spark, sf_dir), "points")
    part = F.pmod(F.xxhash64("sensor_id", "arrived"), F.lit(3))
    for number in range(2):
        table.append(rows.where(part == number), number, "sink")
    table.compact(spark, F.lit("2024-01-29").cast("timestamp"))
    table.append(rows.where(part == 2), 2, "sink")
    hours = RETENTION_HOURS[TOPIC_PROCESSED]
    table.retain(spark, derived.now(), hours)
    table.log.vacuum(spark)
    return spread(points.retained(table.read(spark), derived.now(), hours, "ts"))


@query
def points_last_write_wins(spark, sf_dir):
    identity = ["machine_id", "sensor_id", "metric_type", "ts"]
    return spread(points.last_write_wins(_hourly_points(spark, sf_dir), identity, ARRIVED))


@query
def sink_sensor_metrics(spark, sf_dir):
    rows = points.window_points(_windows(spark, sf_dir)).withColumn(
        ARRIVED, arrival(F.col("ts"), SOURCES.index(TOPIC_PROCESSED), F.lit(0), F.unix_micros("ts"))
    )
    rows = rows.withColumn("ts", F.date_trunc("day", "ts"))
    table = metrics_table(_fresh(spark, "metrics"))
    table.append(rows, 0, "sink")
    return _rounded_stats(spread(table.read(spark)))


@query
def retention_filter(spark, sf_dir):
    kept = points.retained(_raw(spark, sf_dir), derived.now(), hours=168)
    return kept.select("key", "topic", "offset", "timestamp")


@query
def config_upsert_latest(spark, sf_dir):
    return registry.register(derived.config_requests(spark, sf_dir))


@query
def status_current(spark, sf_dir):
    return lifecycle.latest_status(_events(spark, sf_dir))


# ---------------------------------------------------------------- projections and codecs


@query
def envelope_decode(spark, sf_dir):
    decoded = codec.decode_envelope(_raw(spark, sf_dir))
    return decoded.select(
        "offset",
        "type",
        "ingress_ts_nano",
        F.col("payload").isNotNull().alias("has_payload"),
        "has_marker",
        "malformed",
    )


@query
def envelope_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("offset", "key", "route")


@query
def payload_typed_decode(spark, sf_dir):
    names = ["message_id", "sensor_id", "machine_id", "measure"]
    return _typed(spark, sf_dir).select(
        "offset", "payload_ok", *[F.when(F.col("payload_ok"), F.col(n)).alias(n) for n in names]
    )


@query
def sensor_id_fallback(spark, sf_dir):
    return _telemetry(spark, sf_dir).select("offset", "sensor_id")


@query
def event_time_parse(spark, sf_dir):
    texts = derived.timestamp_texts(spark, sf_dir)
    return texts.select("event_id", parse_rfc3339(F.col("text"), F.col("recorded")).alias("ts"))


@query
def value_merge_analyzer(spark, sf_dir):
    return spread(codec.to_window_items(_telemetry(spark, sf_dir), derived.now()))


@query
def value_metric_type(spark, sf_dir):
    return spread(codec.to_telemetry_points(_telemetry(spark, sf_dir), derived.now()))


@query
def ingest_restamp(spark, sf_dir):
    clean = ingest.clean_readings(_raw(spark, sf_dir), restamp=derived.now())
    return clean.select("offset", "sensor_id", "event_time_text")


@query
def envelope_encode(spark, sf_dir):
    return codec.encode_readings(ingest.clean_readings(_raw(spark, sf_dir)))


@query
def marker_passthrough(spark, sf_dir):
    return codec.markers(_routed(spark, sf_dir))


@query
def marker_latency_ms(spark, sf_dir):
    now_nano = F.unix_micros(derived.now()) * 1000
    ms = codec.marker_latency_ms(F.col("ingress_ts_nano"), now_nano)
    marked = _routed(spark, sf_dir).where(F.col("route") == codec.MARKER)
    frame = marked.select("offset", ms.alias("latency_ms"), (ms / 1000.0).alias("latency_seconds"))
    return rounded(frame, "latency_ms", "latency_seconds")


@query
def window_bounds_format(spark, sf_dir):
    return _windows(spark, sf_dir).select(
        "sensor_id",
        "window_end",
        clock_text(F.col("window_start")).alias("start_text"),
        clock_text(F.col("window_end")).alias("end_text"),
    )


@query
def message_id(spark, sf_dir):
    return _windows(spark, sf_dir).select(
        "sensor_id",
        "window_end",
        stable_id(F.col("sensor_id"), F.unix_micros("window_end")).alias("message_id"),
    )


@query
def config_normalize(spark, sf_dir):
    return registry.normalize_requests(derived.config_requests(spark, sf_dir))


@query
def config_type_check(spark, sf_dir):
    checked = registry.check_types(derived.config_requests(spark, sf_dir))
    return checked.select("request_no", "type", "accepted", "message")


@query
def lifecycle_parse(spark, sf_dir):
    return spread(_events(spark, sf_dir))


# ---------------------------------------------------------------- filters


def _in_range(spark, sf_dir, topic):
    typed = _typed(spark, sf_dir).where(F.col("payload_ok") & (F.col("topic") == topic))
    return typed.where(ingest.RANGE_CHECKS[topic](F.col("measure"))).select("offset", "measure")


@query
def filter_temperature_range(spark, sf_dir):
    return _in_range(spark, sf_dir, TOPIC_TEMPERATURE)


@query
def filter_pressure_range(spark, sf_dir):
    return _in_range(spark, sf_dir, TOPIC_PRESSURE)


@query
def ingest_clean(spark, sf_dir):
    return ingest.clean_readings(_raw(spark, sf_dir)).drop("timestamp", "event_id")


@query
def reject_reasons(spark, sf_dir):
    return ingest.reject_reasons(_raw(spark, sf_dir))


@query
def config_missing_anti(spark, sf_dir):
    missing = decide.missing_config(
        _windows(spark, sf_dir), derived.sensor_config(spark, sf_dir)
    )
    return missing.select("sensor_id", "window_end", "n_items")


@query
def late_data_split(spark, sf_dir):
    return _clocked(spark, sf_dir).select("partition", "offset", "sensor_id", "is_late")


# ---------------------------------------------------------------- lifecycle


@query
def lifecycle_asof(spark, sf_dir):
    frame = lifecycle.with_lifecycle(
        derived.readings(spark, sf_dir), _events(spark, sf_dir), SPEC.chunk_us
    )
    return frame.select("partition", "offset", "sensor_id", "state", "session_no", "stopped")


@query
def lifecycle_gate(spark, sf_dir):
    frame = lifecycle.accepted(
        derived.readings(spark, sf_dir), _events(spark, sf_dir), SPEC.chunk_us
    )
    return frame.select("partition", "offset", "sensor_id", "value", "session_no")


@query
def lifecycle_stop_purge(spark, sf_dir):
    return spread(lifecycle.stop_purges(derived.readings(spark, sf_dir), _events(spark, sf_dir), SPEC))


@query
def lifecycle_intervals(spark, sf_dir):
    return rounded(lifecycle.state_intervals(_events(spark, sf_dir), SPEC.chunk_us), "seconds")


# ---------------------------------------------------------------- aggregations and windows


def _bucketed(spark, sf_dir):
    bucket = bucket_start(F.unix_micros("ts"), SPEC.size_us)
    return derived.readings(spark, sf_dir).select(
        "sensor_id",
        "machine_id",
        "value",
        bucket.alias("bucket_us"),
        ((F.unix_micros("ts") - bucket) / F.lit(float(MICROS))).alias("t"),
    )


@query
def window_stats(spark, sf_dir):
    frame = statistics(_bucketed(spark, sf_dir), ["sensor_id", "bucket_us"])
    return _rounded_stats(frame).drop("rate_of_change")


@query
def window_rate_of_change(spark, sf_dir):
    frame = statistics(_bucketed(spark, sf_dir), ["sensor_id", "bucket_us"])
    return _rounded_stats(frame).select("sensor_id", "bucket_us", "rate_of_change")


@query
def running_max_event_time(spark, sf_dir):
    frame = _clocked(spark, sf_dir)
    return frame.select("partition", "offset", "sensor_id", F.timestamp_micros("max_us").alias("max_event_time"))


@query
def per_key_watermark(spark, sf_dir):
    frame = _clocked(spark, sf_dir)
    return frame.select("partition", "offset", "sensor_id", F.timestamp_micros("watermark_us").alias("watermark"))


@query
def sliding_eval_points(spark, sf_dir):
    keys = ["sensor_id"]
    kept = written(_clocked(spark, sf_dir).where(~F.col("is_late")), "clocked")
    frame = evaluations(kept, keys, SPEC)
    return frame.select(*keys, "machine_id", F.timestamp_micros("end_us").alias("window_end"))


@query
def sliding_eval(spark, sf_dir):
    return _rounded_stats(_windows(spark, sf_dir))


@query
def sliding_eval_sessions(spark, sf_dir):
    return _rounded_stats(
        lifecycle.session_windows(derived.readings(spark, sf_dir), _events(spark, sf_dir), SPEC)
    )


@query
def tumbling_mean(spark, sf_dir):
    frame = points.tumbling_mean(
        derived.readings(spark, sf_dir), ["machine_id", "sensor_id"], ["value"], derived.BUCKET_S
    )
    return rounded(frame, "value")


@query
def event_counters(spark, sf_dir):
    records = codec.decode_processed_all(_processed(spark, sf_dir), derived.now())
    config = derived.sensor_config(spark, sf_dir)
    return metrics.count_outcomes(decide.decision_outcomes(records, config))


@query
def event_counters_sink(spark, sf_dir):
    records = codec.decode_processed_all(_processed(spark, sf_dir), derived.now())
    return metrics.count_outcomes(decide.sink_outcomes(records))


@query
def latency_histogram(spark, sf_dir):
    rows = derived.latencies(spark, sf_dir).select((F.col("latency_ms") / 1000.0).alias("s"))
    return rounded(metrics.latency_histogram(rows, "s"), "total_seconds", digits=3)


@query
def lag_gauge_decision(spark, sf_dir):
    decoded = codec.decode_processed(_processed(spark, sf_dir), derived.now())
    lag = metrics.record_lag(derived.now(), F.col("timestamp"))
    return rounded(metrics.last_lag(decoded.where("payload_ok").withColumn(ARRIVED, record_arrival()), lag), "lag_seconds")


@query
def lag_gauge_sink(spark, sf_dir):
    decoded = codec.decode_processed(_processed(spark, sf_dir), derived.now())
    lag = metrics.event_lag(derived.now(), F.col("emit_ts"))
    return rounded(metrics.last_lag(decoded.where("payload_ok").withColumn(ARRIVED, record_arrival()), lag), "lag_seconds")


@query
def lag_max_by_sensor(spark, sf_dir):
    gauge = samples.lag_gauge(spark, sf_dir)
    return metrics.latest_by(
        gauge,
        "processing_lag_seconds",
        ["sensor_id"],
        derived.now(),
        how="max",
        lookback_seconds=_LOOKBACK,
    )


def _counter_now():
    """An instant whose trailing range holds the counters' restart."""
    return F.lit("2024-01-16 12:00:00").cast("timestamp")


_RANGE = 72 * derived.HOUR
#: Short enough that some series have gone stale.
_LOOKBACK = 24 * derived.HOUR
_STEP = 24 * derived.HOUR


@query
def throughput_increase(spark, sf_dir):
    return metrics.increase(
        samples.event_counter(spark, sf_dir),
        "processed_events_total",
        ["type"],
        _counter_now(),
        _RANGE,
        _STEP,
    )


@query
def throughput_rate(spark, sf_dir):
    frame = metrics.rate(
        samples.event_counter(spark, sf_dir),
        "processed_events_total",
        ["type"],
        _counter_now(),
        _RANGE,
        _STEP,
    )
    return rounded(frame, "rate", digits=RATE_DIGITS)


@query
def latency_mean_rate(spark, sf_dir):
    frame = metrics.mean_from_rates(
        samples.latency_series(spark, sf_dir),
        "e2e_latency_seconds",
        ["service"],
        _counter_now(),
        _RANGE,
    )
    return rounded(frame, "mean_seconds")


@query
def gauge_sum_scaled(spark, sf_dir):
    gauge = samples.memory_gauge(spark, sf_dir)
    frame = metrics.latest_by(
        gauge,
        "container_memory_usage_bytes",
        ["name"],
        derived.now(),
        lookback_seconds=_LOOKBACK,
    )
    frame = frame.select("name", (F.col("value") / 1024.0 / 1024.0).alias("mebibytes"))
    return rounded(frame, "mebibytes")


@query
def cpu_percent_rate(spark, sf_dir):
    named = samples.cpu_counter(spark, sf_dir).where(metrics.label("name").rlike(".+"))
    frame = metrics.rate(
        named,
        "container_cpu_usage_seconds_total",
        ["name"],
        _counter_now(),
        _RANGE,
        _STEP,
    )
    frame = frame.select("name", (F.col("rate") * 100.0).alias("cpu_percent"))
    return rounded(frame, "cpu_percent")


@query
def consumer_lag_avg(spark, sf_dir):
    frame = metrics.avg_over_time(
        samples.consumer_lag(spark, sf_dir),
        "kafka_consumergroup_lag",
        ["consumergroup"],
        derived.now(),
        derived.RANGE_S,
    )
    return rounded(frame, "value")


@query
def latency_percentiles(spark, sf_dir):
    return metrics.latency_percentiles(derived.latencies(spark, sf_dir))


@query
def latency_summary(spark, sf_dir):
    return metrics.latency_summary(derived.latencies(spark, sf_dir))


@query
def estimated_rate(spark, sf_dir):
    return rounded(metrics.estimated_rate(derived.sensor_groups(spark, sf_dir)), "rate")


@query
def active_sensors(spark, sf_dir):
    return registry.active_sensors(derived.readings(spark, sf_dir))


# ---------------------------------------------------------------- decisions


def _judged(spark, sf_dir, compat="intended"):
    enriched = decide.with_config(_windows(spark, sf_dir), derived.sensor_config(spark, sf_dir))
    return decide.evaluate_rules(enriched, compat)


@query
def config_enrich(spark, sf_dir):
    enriched = decide.with_config(_windows(spark, sf_dir), derived.sensor_config(spark, sf_dir))
    frame = enriched.select("sensor_id", "window_end", "has_config", *decide.LIMITS)
    return rounded(frame, "max_drift", digits=RATE_DIGITS)


@query
def anomaly_rules(spark, sf_dir):
    return _judged(spark, sf_dir).select("sensor_id", "window_end", "rule_code", "is_anomaly")


@query
def anomaly_rules_as_written(spark, sf_dir):
    judged = _judged(spark, sf_dir, "as_written")
    return judged.select("sensor_id", "window_end", "rule_code", "is_anomaly")


@query
def alarms(spark, sf_dir):
    return decide.alarms(_judged(spark, sf_dir))


@query
def decision_stage(spark, sf_dir):
    decoded = codec.decode_processed(_processed(spark, sf_dir), derived.now())
    usable = decoded.where("payload_ok")
    judged = decide.with_config(usable, derived.sensor_config(spark, sf_dir)).withColumn(
        "rule_code", F.when(F.col("has_config"), decide.rule_code())
    )
    return judged.select(
        "offset",
        "sensor_id",
        F.when(F.col("has_config"), "success").otherwise("redis_config_missing").alias("status"),
        "rule_code",
        F.when(F.col("rule_code").isNotNull(), decide.COMMAND_STOP).alias("command"),
    )


# ---------------------------------------------------------------- snapshot and API


@query
def metrics_snapshot(spark, sf_dir):
    rows = points.window_points(_windows(spark, sf_dir))
    snapshot = points.metrics_snapshot(
        rows, derived.now(), derived.RANGE_S, derived.BUCKET_S
    )
    return snapshot.withColumns({name: F.col(name) + F.lit(0.0) for name in STATS})


@query
def pivot_fields(spark, sf_dir):
    ids = ["machine_id", "sensor_id", "bucket_us"]
    fields = list(STATS)
    wide = _rounded_stats(statistics(_bucketed(spark, sf_dir), ids)).select(*ids, *fields)
    return points.pivot_fields(points.unpivot_fields(wide, ids, fields), ids, fields)


@query
def round_half_away_digits(spark, sf_dir):
    halves = (F.col("event_id") % 41 - 20) * 0.5
    return derived.events(spark, sf_dir).select(
        "event_id",
        (round_half_away(halves, 0) + 0.0).alias("whole"),
        (round_half_away(F.col("value") / 3.0, 5) + 0.0).alias("five_digits"),
    )


@query
def sensor_types(spark, sf_dir):
    return registry.sensor_types(derived.sensor_config(spark, sf_dir))


QUERIES["round_half_away"] = QUERIES.pop("round_half_away_digits")
