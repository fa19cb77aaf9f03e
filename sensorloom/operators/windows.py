"""Data-driven sliding windows per sensor, in batch.

The window of a sensor follows that sensor's own clock: the running maximum of its event times in
arrival order. Rows older than that maximum by more than the lateness are dropped. Whenever the
maximum has moved at least one slide since the last evaluation, the sensor's buffer is evaluated.
The buffer is everything that arrived since the first row not older than ``maximum - size``, which
is the same as: every kept row whose maximum on arrival was at least ``maximum - size``. So each
row only needs its running maximum to know the windows it belongs to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.constants import LATENESS_SECONDS, MICROS, SLIDE_SECONDS, UNITS, WINDOW_SECONDS
from sensorloom.functions.arrival import ARRIVED, arrival_us
from sensorloom.functions.running import Running, with_running
from sensorloom.functions.times import bucket_number, micros
from sensorloom.operators.gate import evaluation_points
from sensorloom.session import written


#: Half an hour of arrivals of one sensor.
CHUNK_SECONDS = 1800


@dataclass(frozen=True)
class WindowSpec:
    """Durations in seconds; ``chunk`` is the stretch of arrivals one task handles per sensor."""

    size: float = WINDOW_SECONDS
    slide: float = SLIDE_SECONDS
    lateness: float = LATENESS_SECONDS
    chunk: float = CHUNK_SECONDS

    @property
    def size_us(self) -> int:
        return micros(self.size)

    @property
    def slide_us(self) -> int:
        return micros(self.slide)

    @property
    def lateness_us(self) -> int:
        return micros(self.lateness)

    @property
    def chunk_us(self) -> int:
        return micros(self.chunk)


def with_event_clock(readings: DataFrame, keys: list[str], spec: WindowSpec) -> DataFrame:
    """Add ``ts_us``, the running maximum ``max_us``, ``is_new_max``, ``watermark_us``, ``is_late``.

    The maximum runs over the arrival order of all sources and partitions. Late rows cannot raise it, so it may
    run over all rows.
    """
    ts_us = F.unix_micros("ts")
    tracked = with_running(
        readings.withColumn("ts_us", ts_us),
        keys,
        ARRIVED,
        spec.chunk_us,
        arrival_us(),
        max_us=Running("max", F.col("ts_us")),
        __before=Running("max", F.col("ts_us"), inclusive=False),
    )
    watermark = F.col("max_us") - F.lit(spec.lateness_us)
    return tracked.select(
        *readings.columns,
        "ts_us",
        "max_us",
        (F.col("__before").isNull() | (F.col("ts_us") > F.col("__before"))).alias("is_new_max"),
        watermark.alias("watermark_us"),
        (F.col("ts_us") < watermark).alias("is_late"),
    )


def evaluations(kept: DataFrame, keys: list[str], spec: WindowSpec) -> DataFrame:
    """The evaluations ``keys, machine_id, end_us`` of rows carrying their event clock."""
    maxima = kept.where("is_new_max").select(*keys, "machine_id", F.col("max_us").alias("end_us"))
    return evaluation_points(maxima, keys, "end_us", spec.slide_us)


def window_members(
    kept: DataFrame, points: DataFrame, keys: list[str], spec: WindowSpec
) -> DataFrame:
    """Each evaluation of ``points`` (``keys, end_us``, more) with every row of its buffer.

    An equi-join on buckets of one window size: a row meets the evaluations of its own and the next
    bucket only, and belongs to at most ``size / slide + 1`` of them. Of the rows sharing the
    maximum of an evaluation only the one that triggered it had arrived by then. Where rows have ``gone_us``, the
    event clock at which a stop took them out, they count up to it.
    """
    bucket = bucket_number(F.col("max_us"), spec.size_us)
    end_bucket = bucket_number(F.col("end_us"), spec.size_us)
    gone = F.col("gone_us") if "gone_us" in kept.columns else F.lit(None).cast("long")
    rows = kept.select(
        *keys, "ts_us", "value", "max_us", "is_new_max", ARRIVED, gone.alias("__gone"), bucket.alias("__b")
    )
    probes = points.withColumn("__b", F.explode(F.array(end_bucket - 1, end_bucket)))
    return rows.join(probes, [*keys, "__b"]).where(
        (F.col("__gone").isNull() | (F.col("end_us") <= F.col("__gone")))
        & (F.col("max_us") >= F.col("end_us") - F.lit(spec.size_us))
        & (
            (F.col("max_us") < F.col("end_us"))
            | (F.col("is_new_max") & (F.col("max_us") == F.col("end_us")))
        )
    )


def mean_of(value: str) -> Column:
    """The mean of a group, the same in any order of its rows.

    Where all values are decimals of at most six places, as sensors write them, their millionths are summed as whole
    numbers, so a mean that meets a threshold exactly doesn't fall beside it. Others have the plain mean.
    """
    units = F.rint(F.col(value) * F.lit(UNITS)).try_cast("long")
    decimal = F.coalesce(units / F.lit(UNITS) == F.col(value), F.col(value).isNull())
    exact = F.try_sum(units) / F.lit(UNITS) / F.count(value)
    return F.coalesce(F.when(F.bool_and(decimal), exact), F.avg(value))


def with_newest_first_sum(members: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``sum_so_far``: the sum of ``value`` from the group's last arrival down to this row."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(ARRIVED).desc())
    running = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return members.withColumn("sum_so_far", F.sum("value").over(running))


def newest_first_mean() -> Column:
    """The mean of a group of ``with_newest_first_sum``: doubles added from the last arrival to the first.

    One order of addition for every window, however its rows are partitioned; it is that of the SQL, whose rules
    compare this sum with the limits to the last digit.
    """
    return F.min_by("sum_so_far", ARRIVED) / F.count("value")


def statistics(members: DataFrame, keys: list[str], mean: Column | None = None) -> DataFrame:
    """Count, minimum, mean, maximum, population standard deviation and rate of change per group.

    ``members`` has ``value`` and seconds ``t``. The rate is the least-squares slope of value over
    seconds, 0.0 where it is undefined (a single row, or all rows at one instant). ``mean`` is
    ``mean_of`` unless given.
    """
    return members.groupBy(*keys).agg(
        F.count("value").alias("n_items"),
        F.min("value").alias("min_value"),
        (mean_of("value") if mean is None else mean).alias("mean_value"),
        F.max("value").alias("max_value"),
        F.stddev_pop("value").alias("std_dev"),
        F.coalesce(F.regr_slope("value", "t"), F.lit(0.0)).alias("rate_of_change"),
    )


def sliding_windows(
    readings: DataFrame, keys: list[str] | None = None, spec: WindowSpec = WindowSpec()
) -> DataFrame:
    """One row per evaluation of every sensor (and session, if among ``keys``).

    ``readings`` has ``sensor_id, machine_id, ts, value, arrived``. The kept rows are written once
    to the shared folder, since the gate and the buffers both read them.
    """
    keys = keys or ["sensor_id"]
    clocked = with_event_clock(readings, keys, spec).where(~F.col("is_late"))
    kept = written(
        clocked.select(*keys, "machine_id", "ts_us", "value", "max_us", "is_new_max", ARRIVED), "kept"
    )
    return windows_of(kept, keys, spec)


def windows_of(kept: DataFrame, keys: list[str], spec: WindowSpec) -> DataFrame:
    """``sliding_windows`` of rows that have their event clock, read from a written table."""
    points = evaluations(kept, keys, spec)
    members = window_members(kept, points, keys, spec)
    members = members.withColumn("t", (F.col("ts_us") - F.col("end_us")) / F.lit(float(MICROS)))
    window = [*keys, "machine_id", "end_us"]
    stats = statistics(with_newest_first_sum(members, window), window, newest_first_mean())
    end = F.col("end_us")
    return stats.select(
        *keys,
        "machine_id",
        F.timestamp_micros(end - F.lit(spec.size_us)).alias("window_start"),
        F.timestamp_micros(end).alias("window_end"),
        "n_items",
        "min_value",
        "mean_value",
        "max_value",
        "std_dev",
        "rate_of_change",
    )
