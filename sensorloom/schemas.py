"""Declared schemas. JSON schemas carry the wire names; frames inside the library use snake_case."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

# --- fixed values: JSON field names of the wire formats ---
ENVELOPE = _struct(
    ("type", _S),
    ("payload", _S),
    ("marker", _struct(("ingress_ts_nano", _L))),
    (CORRUPT, _S),
)
_READING_HEAD = (("messageId", _S), ("sensorId", _S), ("machineId", _S), ("timestamp", _S))
TEMPERATURE_READING = _struct(*_READING_HEAD, ("temperature_celsius", _D), (CORRUPT, _S))
PRESSURE_READING = _struct(*_READING_HEAD, ("pressure_bar", _D), (CORRUPT, _S))
GENERIC_TELEMETRY = _struct(
    *_READING_HEAD, ("temperature_celsius", _D), ("pressure_bar", _D), (CORRUPT, _S)
)
PROCESSED_DATA = _struct(
    ("messageId", _S),
    ("sensorId", _S),
    ("machineId", _S),
    ("minimo", _D),
    ("media", _D),
    ("massimo", _D),
    ("std-dev", _D),
    ("rate-of-change", _D),
    ("timestamp", _S),
    ("windowStart", _S),
    ("windowEnd", _S),
    (CORRUPT, _S),
)
SENSOR_CONFIG = _struct(
    ("sensorId", _S),
    ("type", _S),
    ("machineToControl", _S),
    ("baseMean", _D),
    ("variance", _D),
    ("interval", _L),
    ("soglia_minima", _D),
    ("soglia_massima", _D),
    ("max_std_dev", _D),
    ("max_drift", _D),
    (CORRUPT, _S),
)
ALARM = _struct(("sensorId", _S), ("command", _S), (CORRUPT, _S))
STATUS = _struct(("sensorId", _S), ("machineId", _S), ("status", _S))
# --- end of fixed values ---

#: Same columns as the Kafka source, with text instead of binary key and value.
KAFKA_FRAME = _struct(
    ("key", _S),
    ("value", _S),
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", _L),
    ("timestamp", _TS),
)
#: Records that a stage gives up, as they came.
REJECTS = T.StructType([*KAFKA_FRAME, T.StructField("reason", _S)])
STATS = ("min_value", "mean_value", "max_value", "std_dev", "rate_of_change")
