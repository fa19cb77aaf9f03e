"""Sensor registration and the fleet's configuration table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.constants import SENSOR_TYPES
from sensorloom.functions.scalars import through_float32
from sensorloom.operators.points import last_write_wins

NANOS = 1_000_000_000
_NUMBERS = (
    "base_mean",
    "variance",
    "min_threshold",
    "max_threshold",
    "max_std_dev",
    "max_drift",
)


def normalize_requests(requests: DataFrame, narrow_float32: bool = True) -> DataFrame:
    """Requests with their interval in nanoseconds and, as sent by the API, 32-bit numbers."""
    numbers = {name: F.col(name) for name in _NUMBERS}
    if narrow_float32:
        numbers = {name: through_float32(column) for name, column in numbers.items()}
    interval = (F.col("interval_sec") * F.lit(float(NANOS))).cast("long")
    return requests.withColumns(numbers | {"interval_ns": interval}).drop("interval_sec")


def supported() -> Column:
    """Whether ``type`` is a known sensor type."""
    return F.coalesce(F.col("type").isin(*SENSOR_TYPES), F.lit(False))


def check_types(requests: DataFrame) -> DataFrame:
    """Requests with ``accepted`` and, for rejected ones, a ``message``."""
    return requests.select(
        "*",
        supported().alias("accepted"),
        F.when(
            ~supported(), F.concat(F.lit("unsupported sensor type: "), F.coalesce("type", F.lit("")))
        ).alias("message"),
    )


def upsert(requests: DataFrame, order: str = "request_no") -> DataFrame:
    """The configuration table: the last request per sensor, none for an empty id."""
    return last_write_wins(
        requests.where(F.coalesce(F.col("sensor_id"), F.lit("")) != ""), ["sensor_id"], order
    )


def register(requests: DataFrame, narrow_float32: bool = True) -> DataFrame:
    """The whole registration path: normalise, reject unknown types, upsert."""
    return upsert(normalize_requests(requests.where(supported()), narrow_float32))


def active_sensors(rows: DataFrame) -> DataFrame:
    """Distinct sensor ids."""
    return rows.select("sensor_id").distinct()


def sensor_types(config: DataFrame) -> DataFrame:
    """The known types with the number of configured sensors of each, absent ones as 0."""
    counts = config.groupBy("type").agg(F.count("*").alias("n"))
    known = config.sparkSession.createDataFrame([(t,) for t in SENSOR_TYPES], "type string")
    return known.join(counts, "type", "left").select(
        "type", F.coalesce("n", F.lit(0)).alias("n_sensors")
    )
