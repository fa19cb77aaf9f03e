"""Time-series points: identity, retention, bucketed means, the metrics snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.constants import (
    SNAPSHOT_BUCKET_SECONDS,
    SNAPSHOT_DIGITS,
    SNAPSHOT_RANGE_SECONDS,
)
from sensorloom.functions.scalars import round_half_away
from sensorloom.functions.times import bucket_start, micros
from sensorloom.schemas import STATS

SERIES = ("machine_id", "sensor_id")


def last_write_wins(points: DataFrame, identity: list[str], arrival: str) -> DataFrame:
    """One row per identity: that of the last arrival (a LONG or an arrival order).

    Aggregation rather than a ranking window, so duplicates already collapse before the shuffle: the whole
    last row is one maximum, of a struct that begins with the arrival.
    """
    others = [name for name in points.columns if name not in (*identity, arrival)]
    last = points.groupBy(*identity).agg(F.max(F.struct(arrival, *others)).alias("__last"))
    return last.select(*[F.col(n) if n in identity else F.col(f"__last.{n}").alias(n) for n in points.columns])


def window_points(windows: DataFrame, time_col: str = "window_end") -> DataFrame:
    """Window rows as metric points; message ids and window bounds are dropped.

    ``time_col`` chooses between the end of the window and the time it was emitted.
    """
    return windows.select("sensor_id", "machine_id", *STATS, F.col(time_col).alias("ts"))


def within(rows: DataFrame, now: Column, seconds: float, ts: str = "ts") -> DataFrame:
    """Rows of the last ``seconds``: ``now - seconds <= ts < now``."""
    start = F.timestamp_micros(F.unix_micros(now) - F.lit(micros(seconds)))
    return rows.where((F.col(ts) >= start) & (F.col(ts) < now))


def retained(rows: DataFrame, now: Column, hours: float, ts: str = "timestamp") -> DataFrame:
    """Rows a topic with that retention still holds at ``now``."""
    start = F.timestamp_micros(F.unix_micros(now) - F.lit(micros(hours * 3600)))
    return rows.where(F.col(ts) >= start)


def tumbling_mean(
    rows: DataFrame, series: list[str], fields: list[str], bucket_seconds: float
) -> DataFrame:
    """Mean of each field per series and epoch-aligned bucket; empty buckets give no row."""
    bucket = bucket_start(F.unix_micros("ts"), micros(bucket_seconds)).alias("bucket_us")
    return rows.groupBy(*series, bucket).agg(*[F.avg(name).alias(name) for name in fields])


def metrics_snapshot(
    points: DataFrame,
    now: Column,
    range_seconds: float = SNAPSHOT_RANGE_SECONDS,
    bucket_seconds: float = SNAPSHOT_BUCKET_SECONDS,
    digits: int = SNAPSHOT_DIGITS,
) -> DataFrame:
    """The last bucket mean of each field per machine and sensor, rounded; 0.0 where there is none."""
    fields = list(STATS)
    means = tumbling_mean(within(points, now, range_seconds), list(SERIES), fields, bucket_seconds)
    return means.groupBy(*SERIES).agg(
        *[
            F.coalesce(
                round_half_away(
                    F.max_by(name, F.when(F.col(name).isNotNull(), F.col("bucket_us"))), digits
                ),
                F.lit(0.0),
            ).alias(name)
            for name in fields
        ]
    )


def unpivot_fields(points: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """Wide points to ``field, field_value`` rows."""
    return points.unpivot(ids, fields, "field", "field_value")


def pivot_fields(rows: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """``field, field_value`` rows to one column per named field; naming them saves a pass."""
    return rows.groupBy(*ids).pivot("field", fields).agg(F.max("field_value"))
