"""The streaming stages as queries: derived records arrive in slices, each slice is processed by a
fresh start of the stream from its checkpoint, and the written output is returned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorloom.constants import TOPIC_CLEANED, TOPIC_PRESSURE, TOPIC_PROCESSED, TOPIC_SIGNALS, TOPIC_TEMPERATURE
from sensorloom.functions.arrival import ARRIVED, spread
from sensorloom.operators import codec, ingest, lifecycle
from sensorloom.operators.windows import sliding_windows
from sensorloom.plans.queries import SPEC, _fresh, _rounded_stats, query, rounded
from sensorloom.schemas import KAFKA_FRAME, REJECTS, STATS
from sensorloom.session import ROCKSDB_PROVIDER, written
from sensorloom.sources import derived
from sensorloom.sources.config_table import ConfigTable
from sensorloom.sources.points import metrics_table, telemetry_table
from sensorloom.sources.topics import TopicSink, read_topics, write_topic
from sensorloom.streaming import jobs
from sensorloom.streaming.pipeline import Pipeline

#: Arrivals before and after these instants come as separate slices.
_CUTS = ("2024-01-12 06:00:00", "2024-01-23 18:00:00")


def _slice(at: Column) -> Column:
    """Number of the slice that a record time falls in."""
    return sum((at >= F.lit(cut).cast("timestamp")).cast("int") for cut in _CUTS)


def _in_slices(
    frame: DataFrame, start: Callable[[str, str], DataStreamWriter], at: Column | None = None
) -> None:
    """Feed ``frame`` by slices of the record time ``at`` (by default ``timestamp``) to the stream that
    ``start(source, checkpoint)`` builds.

    Every slice is made of ``frame`` anew, so that its rows are written once, straight to the source. What is costly
    to filter by time (windows, parsed records) should be read from a written table.
    """
    at = F.col("timestamp") if at is None else at
    spark = frame.sparkSession
    source, checkpoint = _fresh(spark, "source"), _fresh(spark, "stream")
    for number in range(len(_CUTS) + 1):
        frame.where(_slice(at) == number).write.mode("append").parquet(source)
        running = start(source, checkpoint).trigger(availableNow=True).start()
        running.awaitTermination()


def _kafka_shaped(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KAFKA_FRAME])


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _fresh(spark, "cleaned")

    def start(source, checkpoint):
        raw = read_topics(spark, [TOPIC_TEMPERATURE, TOPIC_PRESSURE], path=source)
        clean = ingest.cleaned_records(raw)
        return (
            clean.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
        )

    _in_slices(_kafka_shaped(derived.raw_records(spark, sf_dir)), start)
    return spark.read.schema(KAFKA_FRAME).parquet(out).select("key", "value", "topic", "offset")


@query
def stream_sliding_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    events = lifecycle.parse_lifecycle(derived.lifecycle_messages(spark, sf_dir))
    inputs = jobs.merge_inputs(derived.readings(spark, sf_dir), events)
    out = _fresh(spark, "windows")

    def start(source, checkpoint):
        rows = jobs.window_stream(spark.readStream.schema(inputs.schema).parquet(source), SPEC)
        return (
            rows.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
        )

    _in_slices(inputs, start, F.timestamp_micros("at_us"))
    return _rounded_stats(spark.read.parquet(out))


@query
def stream_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = written(sliding_windows(derived.readings(spark, sf_dir), spec=SPEC), "windows")
    records = _kafka_shaped(derived.processed_records(spark, sf_dir, windows))
    alarms = jobs.OutputFolder(_fresh(spark, "alarms"))
    counters = jobs.OutputFolder(_fresh(spark, "counters"))
    body = jobs.decision_body(
        lambda: derived.sensor_config(spark, sf_dir), alarms, counters, derived.now(), "decision"
    )

    def start(source, checkpoint):
        batches = read_topics(spark, [TOPIC_PROCESSED], path=source)
        return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

    _in_slices(records, start)
    rows = alarms.read(spark, "key string, value string")
    return rows.groupBy("key", "value").agg(F.count("*").alias("n"))


def _decided(spark: SparkSession, sf_dir: str) -> jobs.StageHealth:
    """The decision stage over the processed topic, for what it reports about itself."""
    windows = written(sliding_windows(derived.readings(spark, sf_dir), spec=SPEC), "windows")
    records = _kafka_shaped(derived.processed_records(spark, sf_dir, windows))
    folders = [jobs.OutputFolder(_fresh(spark, n)) for n in ("alarms", "counters", "lags", "latencies")]
    health = jobs.StageHealth(folders[2], folders[3])
    config = written(derived.sensor_config(spark, sf_dir), "config")
    body = jobs.decision_body(
        lambda: config, folders[0], folders[1], derived.now(), "decision", health=health
    )

    def start(source, checkpoint):
        batches = read_topics(spark, [TOPIC_PROCESSED], path=source)
        return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

    _in_slices(records, start)
    return health


@query
def stream_decision_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_decided(spark, sf_dir).last_lags(spark), "lag_seconds")


@query
def stream_decision_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = _decided(spark, sf_dir).histogram(spark)
    return histogram.select("le", "n", "total_n")


@query
def stream_telemetry_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = written(ingest.cleaned_records(derived.raw_records(spark, sf_dir)), "cleaned")
    table = telemetry_table(_fresh(spark, "telemetry"))
    body = jobs.telemetry_sink(table, derived.now(), "telemetry")

    def start(source, checkpoint):
        batches = read_topics(spark, [TOPIC_CLEANED], path=source)
        return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

    _in_slices(_kafka_shaped(cleaned), start)
    return spread(table.read(spark))


@query
def stream_metrics_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed topic to metric points. The sink starts over with a fresh checkpoint (and so a new
    writer name) and reads everything again: the points stay the same."""
    windows = written(sliding_windows(derived.readings(spark, sf_dir), spec=SPEC), "windows")
    records = _kafka_shaped(derived.processed_records(spark, sf_dir, windows))
    table = metrics_table(_fresh(spark, "metrics"))
    counters = jobs.OutputFolder(_fresh(spark, "counters"))

    def started_as(writer):
        body = jobs.metrics_sink(table, counters, derived.now(), writer)

        def start(source, checkpoint):
            batches = read_topics(spark, [TOPIC_PROCESSED], path=source)
            return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

        return start

    for writer in ("metrics-1", "metrics-2"):
        _in_slices(records, started_as(writer))
    return _rounded_stats(table.read(spark)).drop(ARRIVED)


@query
def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = derived.lifecycle_messages(spark, sf_dir)
    feed = jobs.OutputFolder(_fresh(spark, "status"))
    body = jobs.status_body(feed, "status")

    def start(source, checkpoint):
        batches = spark.readStream.schema(messages.schema).parquet(source)
        return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

    _in_slices(messages, start, F.col("arrived.at"))
    return jobs.current_status(spark, feed)


def _emitted() -> Column:
    """When a window's record is written: an hour after its end."""
    return F.col("window_end") + derived.hours(F.lit(1))


def _cleaned_and_lifecycle(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cleaned = _kafka_shaped(ingest.cleaned_records(derived.raw_records(spark, sf_dir)))
    return written(cleaned, "cleaned"), written(derived.lifecycle_messages(spark, sf_dir), "lifecycle")


@query
def stream_analyzer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned topic and the lifecycle channel, two sources of one query, to the processed topic: windows
    of running sensors, and the markers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    cleaned, messages = _cleaned_and_lifecycle(spark, sf_dir)
    records, channel, out, checkpoint = (_fresh(spark, n) for n in ("cleaned", "channel", "processed", "analyzer"))
    for number in range(len(_CUTS) + 1):
        cleaned.where(_slice(F.col("timestamp")) == number).write.mode("append").parquet(records)
        messages.where(_slice(F.col("arrived.at")) == number).write.mode("append").parquet(channel)
        made = jobs.processed_stream(
            read_topics(spark, [TOPIC_CLEANED], path=records),
            lifecycle.parse_lifecycle(spark.readStream.schema(messages.schema).parquet(channel)),
            derived.now(),
            _emitted(),
            SPEC,
        )
        writer = write_topic(made, TOPIC_PROCESSED, checkpoint=checkpoint, path=out)
        writer.trigger(availableNow=True).start().awaitTermination()
    processed = read_topics(spark, [TOPIC_PROCESSED], path=out, streaming=False)
    decoded = codec.decode_windows(processed, derived.now())
    return _rounded_stats(
        decoded.select("key", "route", "machine_id", *STATS, F.when(F.col("payload_ok"), F.col("emit_ts")).alias("emit_ts"))
    )


@query
def stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records to alarms and both point tables, through five queries and the topics between them. Each slice
    of arrivals is a restart of all of them."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    raw = written(_kafka_shaped(derived.raw_records(spark, sf_dir)), "raw")
    messages = written(derived.lifecycle_messages(spark, sf_dir), "lifecycle")
    config = written(derived.sensor_config(spark, sf_dir), "config")
    records, channel = _fresh(spark, "raw-topics"), _fresh(spark, "channel")
    service = Pipeline(
        spark,
        _fresh(spark, "pipeline"),
        raw=lambda: read_topics(spark, [TOPIC_TEMPERATURE, TOPIC_PRESSURE], path=records),
        lifecycle=lambda: lifecycle.parse_lifecycle(spark.readStream.schema(messages.schema).parquet(channel)),
        config=lambda: config,
        now=derived.now(),
        emitted_at=_emitted(),
        spec=SPEC,
    )
    for number in range(len(_CUTS) + 1):
        raw.where(_slice(F.col("timestamp")) == number).write.mode("append").parquet(records)
        messages.where(_slice(F.col("arrived.at")) == number).write.mode("append").parquet(channel)
        service.drain()
    none = F.lit(None).cast("string")
    telemetry = service.telemetry.read(spark).select(
        F.lit("telemetry").alias("sink"), "sensor_id", "machine_id", "ts", F.col("metric_type").alias("name"), "value"
    )
    windows = service.metrics.read(spark).drop(ARRIVED)
    windows = windows.unpivot(["sensor_id", "machine_id", "ts"], list(STATS), "name", "value")
    alarms = service.alarms.read(spark).select(
        F.lit("signals").alias("sink"),
        F.col("key").alias("sensor_id"),
        none.alias("machine_id"),
        F.col("timestamp").alias("ts"),
        F.col("value").alias("name"),
        F.lit(None).cast("double").alias("value"),
    )
    every = telemetry.unionByName(windows.withColumn("sink", F.lit("metrics"))).unionByName(alarms)
    return rounded(every, "value")


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ingest and decision stages give up, each from the one parse that feeds their main output."""
    windows = written(sliding_windows(derived.readings(spark, sf_dir), spec=SPEC), "windows")
    processed = _kafka_shaped(derived.processed_records(spark, sf_dir, windows))
    config = written(derived.sensor_config(spark, sf_dir), "config")
    rejects = {stage: jobs.OutputFolder(_fresh(spark, f"{stage}-rejects")) for stage in ("ingest", "decision")}
    counters = [jobs.OutputFolder(_fresh(spark, "counters")) for _ in rejects]
    cleaned = TopicSink(TOPIC_CLEANED, _fresh(spark, "cleaned"))
    alarms = TopicSink(TOPIC_SIGNALS, _fresh(spark, "signals"))
    bodies = {
        "ingest": jobs.ingest_body(cleaned, rejects["ingest"], counters[0], "ingest"),
        "decision": jobs.decision_body(
            lambda: config, alarms, counters[1], derived.now(), "decision", rejects=rejects["decision"]
        ),
    }

    def starting(body, *topics):
        def start(source, checkpoint):
            batches = read_topics(spark, topics, path=source)
            return batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)

        return start

    raw = _kafka_shaped(derived.raw_records(spark, sf_dir))
    _in_slices(raw, starting(bodies["ingest"], TOPIC_TEMPERATURE, TOPIC_PRESSURE))
    _in_slices(processed, starting(bodies["decision"], TOPIC_PROCESSED))
    found = [rejects[s].read(spark, REJECTS).withColumn("stage", F.lit(s)) for s in rejects]
    return found[0].unionByName(found[1]).select("stage", "reason", "key", "topic", "partition", "offset", "timestamp")


def _requests_in_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration requests with the ``slice`` that they arrive in."""
    requests = derived.config_requests(spark, sf_dir)
    times = derived.events(spark, sf_dir).select(F.col("event_id").alias("request_no"), _slice(F.col("ts")).alias("slice"))
    return written(requests.join(times, "request_no"), "requests")


def _registering(spark: SparkSession, table: ConfigTable, requests: DataFrame) -> Callable[[int], None]:
    """A stream of requests into the stored configuration, a slice at a time."""
    source, checkpoint = _fresh(spark, "requests"), _fresh(spark, "registry")
    rows = requests.drop("slice")

    def arrive(number: int) -> None:
        requests.where(F.col("slice") == number).drop("slice").write.mode("append").parquet(source)
        batches = spark.readStream.schema(rows.schema).parquet(source)
        writer = batches.writeStream.foreachBatch(jobs.config_body(table, "registry"))
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    return arrive


@query
def config_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests stream into the stored configuration, whose deltas are merged into its base on the way; a batch
    that is replayed changes nothing."""
    table = ConfigTable(_fresh(spark, "config"), deltas=1)
    requests = _requests_in_slices(spark, sf_dir)
    arrive = _registering(spark, table, requests)
    for number in range(len(_CUTS) + 1):
        arrive(number)
    table.register(requests.where("slice = 0").drop("slice"), 0, "registry")
    return table.snapshot(spark)


@query
def stream_decision_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions while registrations arrive: every batch is judged by the configuration stored at its time."""
    windows = written(sliding_windows(derived.readings(spark, sf_dir), spec=SPEC), "windows")
    records = _kafka_shaped(derived.processed_records(spark, sf_dir, windows))
    table = ConfigTable(_fresh(spark, "config"))
    arrive = _registering(spark, table, _requests_in_slices(spark, sf_dir))
    alarms = TopicSink(TOPIC_SIGNALS, _fresh(spark, "signals"))
    counters = jobs.OutputFolder(_fresh(spark, "counters"))
    body = jobs.decision_body(lambda: table.snapshot(spark), alarms, counters, derived.now(), "decision")
    source, checkpoint = _fresh(spark, "source"), _fresh(spark, "decision")
    for number in range(len(_CUTS) + 1):
        arrive(number)
        records.where(_slice(F.col("timestamp")) == number).write.mode("append").parquet(source)
        batches = read_topics(spark, [TOPIC_PROCESSED], path=source)
        writer = batches.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    return alarms.read(spark).select("key", "value", "partition", "offset", "timestamp")


@query
def window_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the window stage holds when it is stopped, read from its checkpoint: every sensor's clock and buffer."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    events = lifecycle.parse_lifecycle(derived.lifecycle_messages(spark, sf_dir))
    inputs = jobs.merge_inputs(derived.readings(spark, sf_dir), events)
    kept = []

    def start(source, checkpoint):
        kept.append(checkpoint)
        rows = jobs.window_stream(spark.readStream.schema(inputs.schema).parquet(source), SPEC)
        return rows.writeStream.format("noop").option("checkpointLocation", checkpoint)

    _in_slices(inputs, start, F.timestamp_micros("at_us"))
    return rounded(jobs.window_state(spark, kept[-1], SPEC), "value_sum")
