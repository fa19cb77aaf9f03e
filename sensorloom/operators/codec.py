"""Decoding, routing and encoding of topic records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom import schemas
from sensorloom.constants import (
    TOPIC_PRESSURE,
    TOPIC_TEMPERATURE,
    TYPE_DATA,
    TYPE_MARKER,
)
from sensorloom.functions.arrival import record_arrival
from sensorloom.functions.scalars import first_nonzero, or_key, stable_id
from sensorloom.functions.times import clock_text, parse_rfc3339, rfc3339_seconds

#: Name of the member that ends a wrapped text; no record has it.
_LAST = "__end_of_record__"
DATA, MARKER, UNHANDLED, MALFORMED = "data", "marker", "unhandled", "malformed"
#: Text fields of a reading's payload and their columns.
_READING = (
    ("messageId", "message_id"),
    ("sensorId", "sensor_id"),
    ("machineId", "machine_id"),
    ("timestamp", "event_time_text"),
)
#: Numbers of a window's payload and their columns.
_WINDOW = (
    ("minimo", "min_value"),
    ("media", "mean_value"),
    ("massimo", "max_value"),
    ("std-dev", "std_dev"),
    ("rate-of-change", "rate_of_change"),
)


def parse_once(frame: DataFrame, **parsed: tuple[Column, object]) -> DataFrame:
    """Add struct columns parsed from JSON text, ``name=(text, schema)``, null for null text.

    Parsing is strict: quotes are double, numbers are numbers, and nothing follows the value. Spark's
    parser stops at the end of a value, so the text is read as one member of an object whose last member
    must be reached; text after the value spoils that. One parse gives the value, the end and the corrupt text.

    Exploding a one-element array keeps the parse out of reach of the optimizer's filter push-down
    and projection merging, which would copy it into every expression that looks at a field.
    """
    for name, (text, schema) in parsed.items():
        frame = frame.select("*", F.explode(F.array(_whole(text, schema))).alias("__whole"))
        value = F.col("__whole.value").withField(schemas.CORRUPT, F.when(_spoilt(F.col("__whole")), text))
        frame = frame.withColumn(name, value).drop("__whole")
    return frame


def _whole(text: Column, schema: T.StructType) -> Column:
    """The text as member ``value`` of an object, with the object's end and its corrupt text."""
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": schemas.CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    wrapped = F.concat(F.lit('{"value":'), text, F.lit(f',"{_LAST}":1}}'))
    whole = T.StructType(
        [
            T.StructField("value", _fields(schema)),
            T.StructField(_LAST, T.IntegerType()),
            T.StructField(schemas.CORRUPT, T.StringType()),
        ]
    )
    return F.from_json(wrapped, whole, options)


def _fields(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != schemas.CORRUPT])


def _spoilt(whole: Column) -> Column:
    return whole.getField(schemas.CORRUPT).isNotNull() | whole.getField(_LAST).isNull()


def unusable(parsed: str) -> Column:
    return F.col(parsed).isNull() | F.col(f"{parsed}.{schemas.CORRUPT}").isNotNull()


def decode_envelope(records: DataFrame) -> DataFrame:
    """Add ``type, payload, ingress_ts_nano, has_marker, malformed`` parsed from ``value``.

    The payload stays raw JSON text. A present marker without its number reads as 0. Nothing of a malformed
    record is read: its type is empty.
    """
    parsed = parse_once(records, __env=(F.col("value"), schemas.ENVELOPE))
    return parsed.select(
        *records.columns,
        F.coalesce(F.col("__env.type"), F.lit("")).alias("type"),
        F.col("__env.payload").alias("payload"),
        F.when(
            F.col("__env.marker").isNotNull(),
            F.coalesce(F.col("__env.marker.ingress_ts_nano"), F.lit(0)),
        ).alias("ingress_ts_nano"),
        F.coalesce(F.col("__env.marker").isNotNull(), F.lit(False)).alias("has_marker"),
        unusable("__env").alias("malformed"),
    )


def route(decoded: DataFrame, has_payload: Column | None = None) -> DataFrame:
    """Add ``route``: ``marker``, ``data``, ``unhandled`` or ``malformed``."""
    is_marker = (F.col("type") == TYPE_MARKER) & F.col("has_marker")
    has_payload = F.col("payload").isNotNull() if has_payload is None else has_payload
    is_data = (F.col("type") == TYPE_DATA) & has_payload
    return decoded.withColumn(
        "route",
        F.when(F.col("malformed"), MALFORMED)
        .when(is_marker, MARKER)
        .when(is_data, DATA)
        .otherwise(UNHANDLED),
    )


def decode_and_route(records: DataFrame) -> DataFrame:
    return route(decode_envelope(records))


def _named(parsed: Column, make: Callable[[Column], Column]) -> Column:
    """An array of the one value that ``make`` makes of ``parsed``, which is evaluated once."""
    return F.transform(F.array(parsed), make)


def _parsed_at_once(records: DataFrame, shape: T.StructType, kinds: Sequence[tuple[Column, T.StructType]]) -> DataFrame:
    """``decode_and_route`` with the payload of data records as struct ``__payload`` and ``payload_ok``, instead of its
    text. The schema of a payload is that of the first of ``kinds`` whose condition holds; ``shape`` has the fields of all.

    Envelope and payload are one parse. Only a text that it can't take as a whole is parsed again, first its envelope
    and then the payload's text by the payload's own schema, which tells what is at fault.
    """
    shape = _fields(shape)
    at_once = T.StructType([T.StructField("payload", shape) if f.name == "payload" else f for f in schemas.ENVELOPE])
    doubles = [f.name for f in shape if isinstance(f.dataType, T.DoubleType)]

    def found(envelope: Column, malformed: Column, payload: Column, payload_ok: Column) -> Column:
        marker = envelope.getField("marker")
        return F.struct(
            F.coalesce(envelope.getField("type"), F.lit("")).alias("type"),
            F.when(marker.isNotNull(), F.coalesce(marker.getField("ingress_ts_nano"), F.lit(0))).alias("ingress_ts_nano"),
            marker.isNotNull().alias("has_marker"),
            malformed.alias("malformed"),
            envelope.getField("payload").isNotNull().alias("has_payload"),
            payload.alias("payload"),
            payload_ok.alias("payload_ok"),
        )

    def in_shape(value: Column, schema: T.StructType) -> Column:
        known = schema.fieldNames()
        return F.struct(
            *[
                (value.getField(f.name) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in shape
            ]
        )

    def one_by_one(whole: Column) -> Column:
        envelope = whole.getField("value")
        malformed = _spoilt(whole) | envelope.isNull()
        data = ~malformed & (envelope.getField("type") == TYPE_DATA)

        def judged(schema: T.StructType) -> Column:
            return _named(
                _whole(F.when(data, envelope.getField("payload")), schema),
                lambda w: found(
                    envelope, malformed, in_shape(w.getField("value"), schema), ~(_spoilt(w) | w.getField("value").isNull())
                ),
            )[0]

        made = found(envelope, malformed, F.lit(None).cast(shape), F.lit(False))
        for condition, schema in reversed(kinds):
            made = F.when(condition, judged(schema)).otherwise(made)
        return made

    def either(whole: Column) -> Column:
        envelope = whole.getField("value")
        payload = envelope.getField("payload")
        sound = ~_spoilt(whole) & envelope.isNotNull()
        for name in doubles:  # what is beyond a double becomes infinite here and is refused in a payload's own parse
            sound &= F.coalesce(F.abs(payload.getField(name)) != F.lit(float("inf")), F.lit(True))
        again = _named(_whole(F.col("value"), schemas.ENVELOPE), one_by_one)[0]
        return F.when(sound, found(envelope, F.lit(False), payload, payload.isNotNull())).otherwise(again)

    parsed = records.select("*", F.explode(_named(_whole(F.col("value"), at_once), either)).alias("__r"))
    routed = route(
        parsed.select(
            *records.columns,
            *[F.col(f"__r.{name}").alias(name) for name in ("type", "ingress_ts_nano", "has_marker", "malformed")],
            "__r",
        ),
        F.col("__r.has_payload"),
    )
    typed = (F.col("route") == DATA) & reduce(or_, [condition for condition, _ in kinds])
    return routed.withColumns(
        {
            "__payload": F.when(typed, F.col("__r.payload")),
            "payload_ok": F.coalesce(typed & F.col("__r.payload_ok"), F.lit(False)),
        }
    ).drop("__r")


def decode_readings(records: DataFrame) -> DataFrame:
    """``decode_typed_payload(decode_and_route(records))`` in one parse; the text of the payload isn't kept."""
    warm, tight = (F.col("topic") == topic for topic in (TOPIC_TEMPERATURE, TOPIC_PRESSURE))
    kinds = [(warm, schemas.TEMPERATURE_READING), (tight, schemas.PRESSURE_READING)]
    parsed = _parsed_at_once(records, schemas.GENERIC_TELEMETRY, kinds)
    measure = F.when(warm, F.col("__payload.temperature_celsius")).otherwise(F.col("__payload.pressure_bar"))
    return parsed.select(
        *[c for c in parsed.columns if c not in ("__payload", "payload_ok")],
        *[F.coalesce(F.col(f"__payload.{wire}"), F.lit("")).alias(name) for wire, name in _READING],
        F.coalesce(measure, F.lit(0.0)).alias("measure"),
        "payload_ok",
    )


def decode_typed_payload(routed: DataFrame) -> DataFrame:
    """Rows of the two sensor topics with their payload fields and ``measure``.

    Each topic has its own schema; a missing measure reads as 0.0, missing text as ''. Rows without
    a usable payload have ``payload_ok = false``.
    """
    is_data = F.col("route") == DATA
    warm, tight = (F.col("topic") == topic for topic in (TOPIC_TEMPERATURE, TOPIC_PRESSURE))
    payload = F.col("payload")
    return (
        parse_once(
            routed,
            __t=(F.when(is_data & warm, payload), schemas.TEMPERATURE_READING),
            __p=(F.when(is_data & tight, payload), schemas.PRESSURE_READING),
        )
        .select(
            *routed.columns,
            *[
                F.coalesce(F.col(f"__t.{wire}"), F.col(f"__p.{wire}"), F.lit("")).alias(name)
                for wire, name in _READING
            ],
            F.coalesce("__t.temperature_celsius", "__p.pressure_bar", F.lit(0.0)).alias("measure"),
            (~(unusable("__t") & unusable("__p"))).alias("payload_ok"),
        )
    )


def decode_telemetry(cleaned: DataFrame) -> DataFrame:
    """Data rows of the cleaned topic: the union payload with nullable measures.

    Rows with a wrongly typed payload are dropped, an empty sensor id falls back to the record key.
    """
    data = cleaned.where(F.col("route") == DATA)
    parsed = parse_once(data, __g=(F.col("payload"), schemas.GENERIC_TELEMETRY))
    return parsed.where(~unusable("__g")).select(
        *cleaned.columns,
        or_key(F.col("__g.sensorId"), F.col("key")).alias("sensor_id"),
        F.coalesce("__g.machineId", F.lit("")).alias("machine_id"),
        F.col("__g.timestamp").alias("event_time_text"),
        F.col("__g.temperature_celsius").alias("temperature_celsius"),
        F.col("__g.pressure_bar").alias("pressure_bar"),
    )


def to_window_items(telemetry: DataFrame, now: Column) -> DataFrame:
    """Telemetry as window input ``sensor_id, machine_id, ts, value, arrived``.

    A missing measure becomes 0.0 and an unreadable time becomes ``now``.
    """
    return telemetry.select(
        "sensor_id",
        "machine_id",
        parse_rfc3339(F.col("event_time_text"), now).alias("ts"),
        first_nonzero(F.col("temperature_celsius"), F.col("pressure_bar")).alias("value"),
        record_arrival(),
    )


def to_telemetry_points(telemetry: DataFrame, now: Column) -> DataFrame:
    """Telemetry as raw points, tagged with the metric type; rows without any measure are dropped."""
    return telemetry.select(
        "machine_id",
        "sensor_id",
        F.when(F.col("temperature_celsius").isNotNull(), F.lit("temperature"))
        .otherwise(F.lit("pressure"))
        .alias("metric_type"),
        F.coalesce("temperature_celsius", "pressure_bar").alias("value"),
        parse_rfc3339(F.col("event_time_text"), now).alias("ts"),
        record_arrival(),
    ).where(F.col("value").isNotNull())


def decode_processed(routed: DataFrame, now: Column) -> DataFrame:
    """Data rows of the processed topic as window rows; ``payload_ok`` marks unusable payloads."""
    return decode_processed_all(routed.where(F.col("route") == DATA), now)


def decode_processed_all(routed: DataFrame, now: Column) -> DataFrame:
    """Every row of the processed topic, data rows decoded as windows: one parse for a whole stage.

    ``payload_ok`` is true only for data rows with a usable payload.
    """
    is_data = F.col("route") == DATA
    parsed = parse_once(routed, __w=(F.when(is_data, F.col("payload")), schemas.PROCESSED_DATA))
    return parsed.select(
        *routed.columns,
        *_window_columns("__w", now),
        (~unusable("__w")).alias("payload_ok"),
    )


def decode_windows(records: DataFrame, now: Column) -> DataFrame:
    """``decode_processed_all(decode_and_route(records), now)`` in one parse; the text of the payload isn't kept."""
    parsed = _parsed_at_once(records, schemas.PROCESSED_DATA, [(F.lit(True), schemas.PROCESSED_DATA)])
    return parsed.select(
        *[c for c in parsed.columns if c not in ("__payload", "payload_ok")],
        *_window_columns("__payload", now),
        "payload_ok",
    )


def _window_columns(payload: str, now: Column) -> list[Column]:
    return [
        F.coalesce(f"{payload}.messageId", F.lit("")).alias("message_id"),
        or_key(F.col(f"{payload}.sensorId"), F.col("key")).alias("sensor_id"),
        F.coalesce(f"{payload}.machineId", F.lit("")).alias("machine_id"),
        *[F.coalesce(F.col(f"{payload}.`{wire}`"), F.lit(0.0)).alias(name) for wire, name in _WINDOW],
        parse_rfc3339(F.col(f"{payload}.timestamp"), now).alias("emit_ts"),
    ]


def envelope(payload: Column) -> Column:
    """JSON envelope text around a payload struct."""
    return F.to_json(F.struct(F.lit(TYPE_DATA).alias("type"), payload.alias("payload")))


def reading_envelope() -> Column:
    """Cleaned-topic JSON of a typed reading, with the field name of its topic."""
    head = [
        F.col("message_id").alias("messageId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("machine_id").alias("machineId"),
        F.col("event_time_text").alias("timestamp"),
    ]
    warm = envelope(F.struct(*head, F.col("measure").alias("temperature_celsius")))
    tight = envelope(F.struct(*head, F.col("measure").alias("pressure_bar")))
    return F.when(F.col("topic") == TOPIC_TEMPERATURE, warm).otherwise(tight)


def encode_readings(clean: DataFrame) -> DataFrame:
    """Clean readings as cleaned-topic records ``key, value``, keyed by sensor."""
    return clean.select(
        F.col("sensor_id").alias("key"), reading_envelope().alias("value"), "partition", "offset", "timestamp"
    )


def processed_envelope(emitted_at: Column, session_no: Column | None = None) -> Column:
    """Processed-topic JSON of a window row.

    Two sessions of a sensor may end a window at one instant: where rows have a session, it is part of
    the message id.
    """
    session = [] if session_no is None else [session_no]
    payload = F.struct(
        stable_id(F.col("sensor_id"), *session, F.unix_micros("window_end")).alias("messageId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("machine_id").alias("machineId"),
        F.col("min_value").alias("minimo"),
        F.col("mean_value").alias("media"),
        F.col("max_value").alias("massimo"),
        F.col("std_dev").alias("std-dev"),
        F.col("rate_of_change").alias("rate-of-change"),
        rfc3339_seconds(emitted_at).alias("timestamp"),
        clock_text(F.col("window_start")).alias("windowStart"),
        clock_text(F.col("window_end")).alias("windowEnd"),
    )
    return envelope(payload)


def encode_windows(windows: DataFrame, emitted_at: Column) -> DataFrame:
    """Window rows as processed-topic records ``key, value``, keyed by sensor."""
    session = F.col("session_no") if "session_no" in windows.columns else None
    return windows.select(
        F.col("sensor_id").alias("key"), processed_envelope(emitted_at, session).alias("value")
    )


def window_records(windows: DataFrame, emitted_at: Column) -> DataFrame:
    """Window rows as records of the processed topic, with the columns a topic in files needs.

    ``windows`` has ``session_no``. Records of one sensor are in order: two windows of one instant belong to
    two sessions.
    """
    return windows.select(
        F.col("sensor_id").alias("key"),
        processed_envelope(emitted_at, F.col("session_no")).alias("value"),
        F.lit(0).alias("partition"),
        (F.unix_micros("window_end") + F.col("session_no")).alias("offset"),
        emitted_at.alias("timestamp"),
    )


def marker_records(routed: DataFrame) -> DataFrame:
    """Latency markers as records of the next topic, unchanged."""
    return routed.where(F.col("route") == MARKER).select("key", "value", "partition", "offset", "timestamp")


def markers(routed: DataFrame) -> DataFrame:
    """Latency markers, key and value unchanged."""
    return routed.where(F.col("route") == MARKER).select("key", "value", "topic", "partition", "offset")


def marker_latency_ms(ingress_ts_nano: Column, now_nano: Column) -> Column:
    """Milliseconds between a marker's ingress and ``now_nano``."""
    return (now_nano - ingress_ts_nano).cast("double") / F.lit(1e6)
