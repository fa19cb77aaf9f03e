"""Metric samples ``ts, metric, labels, value`` derived from ``events``, as a scraper would store
them: cumulative counters, gauges, latency sums and counts. Scrapes happen every six hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.constants import MICROS
from sensorloom.functions.running import Running, with_running
from sensorloom.functions.times import bucket_start
from sensorloom.sources.derived import HOUR, events

SCRAPE_US = 6 * HOUR * MICROS
#: Counters restart from zero here.
RESET_TEXT = "2024-01-15 00:00:00"


def _scrape() -> Column:
    return bucket_start(F.unix_micros("ts"), SCRAPE_US) + SCRAPE_US


def _counter(counts: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Per-scrape amounts (``at_us``, ``amount``) to a cumulative counter with one restart."""
    reset = F.unix_micros(F.lit(RESET_TEXT).cast("timestamp"))
    counts = counts.withColumn("epoch_no", (F.col("at_us") > reset).cast("int"))
    totals = with_running(
        counts,
        [*keys, "epoch_no"],
        "at_us",
        SCRAPE_US * 4096,
        total=Running("sum", F.col("amount")),
    )
    return totals.select(
        F.timestamp_micros("at_us").alias("ts"),
        F.lit(metric).alias("metric"),
        F.create_map(*[c for k in keys for c in (F.lit(k), F.col(k))]).alias("labels"),
        F.col("total").cast("double").alias("value"),
    )


def event_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``processed_events_total`` by type and status."""
    status = F.when(F.col("event_id") % 10 == 0, "ignored").otherwise("success")
    counts = (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("type"), status.alias("status"), _scrape().alias("at_us"))
        .agg(F.count("*").alias("amount"))
    )
    return _counter(counts, ["type", "status"], "processed_events_total")


def latency_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``e2e_latency_seconds_sum`` and ``_count`` by service."""
    seconds = ((F.col("event_id") * 37) % 20000) / 1000.0
    service = F.when(F.col("user_id") % 3 == 0, "decision").otherwise("sink")
    per = (
        events(spark, sf_dir)
        .groupBy(service.alias("service"), _scrape().alias("at_us"))
        .agg(F.sum(seconds).alias("s"), F.count("*").alias("n"))
    )
    sums = per.select("service", "at_us", F.col("s").alias("amount"))
    counts = per.select("service", "at_us", F.col("n").alias("amount"))
    return _counter(sums, ["service"], "e2e_latency_seconds_sum").unionByName(
        _counter(counts, ["service"], "e2e_latency_seconds_count")
    )


def cpu_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``container_cpu_usage_seconds_total`` by container name; one container has no name."""
    name = F.when(F.col("user_id") % 8 == 7, F.lit("")).otherwise(
        F.concat(F.lit("svc_"), (F.col("user_id") % 8).cast("string"))
    )
    counts = (
        events(spark, sf_dir)
        .groupBy(
            name.alias("name"),
            F.concat(F.lit("cpu"), (F.col("user_id") % 2).cast("string")).alias("cpu"),
            _scrape().alias("at_us"),
        )
        .agg(F.sum("value").alias("amount"))
    )
    return _counter(counts, ["name", "cpu"], "container_cpu_usage_seconds_total")


def _gauge(rows: DataFrame, keys: list[str], metric: str) -> DataFrame:
    return rows.select(
        "ts",
        F.lit(metric).alias("metric"),
        F.create_map(*[c for k in keys for c in (F.lit(k), F.col(k))]).alias("labels"),
        F.col("value").cast("double").alias("value"),
    )


def memory_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``container_memory_usage_bytes`` by container name and instance, one sample per event."""
    rows = events(spark, sf_dir).select(
        "ts",
        F.concat(F.lit("svc_"), (F.col("user_id") % 6).cast("string")).alias("name"),
        F.col("user_id").cast("string").alias("instance"),
        (F.col("value") * 1_000_000.0).alias("value"),
    )
    return _gauge(rows, ["name", "instance"], "container_memory_usage_bytes")


def lag_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``processing_lag_seconds`` by sensor, from two service instances."""
    rows = events(spark, sf_dir).select(
        "ts",
        F.col("user_id").cast("string").alias("sensor_id"),
        F.concat(F.lit("instance_"), (F.col("event_id") % 2).cast("string")).alias("instance"),
        ((F.col("event_id") * 13) % 700 / 10.0).alias("value"),
    )
    return _gauge(rows, ["sensor_id", "instance"], "processing_lag_seconds")


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kafka_consumergroup_lag`` by consumer group and partition."""
    rows = events(spark, sf_dir).select(
        "ts",
        F.concat(F.lit("group_"), F.col("event_type")).alias("consumergroup"),
        (F.col("user_id") % 4).cast("string").alias("partition"),
        ((F.col("event_id") * 31) % 500).alias("value"),
    )
    return _gauge(rows, ["consumergroup", "partition"], "kafka_consumergroup_lag")
