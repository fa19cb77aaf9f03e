"""The ingest stage: range checks, re-stamping, reject accounting."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.constants import (
    PRESSURE_CLOSED_RANGE,
    TEMPERATURE_OPEN_RANGE,
    TOPIC_CLEANED,
    TOPIC_PRESSURE,
    TOPIC_TEMPERATURE,
)
from sensorloom.functions.times import rfc3339_seconds
from sensorloom.operators.codec import (
    DATA,
    MALFORMED,
    MARKER,
    UNHANDLED,
    decode_and_route,
    decode_readings,
    decode_typed_payload,
    reading_envelope,
)

Validity = Callable[[Column], Column]
#: Outcomes of records that are given up, unlike those that are none of the stage's business.
REJECTED = ("malformed_envelope", "malformed_payload", "out_of_range")
ACCEPTED = "accepted"


def plausible_temperature(value: Column) -> Column:
    low, high = TEMPERATURE_OPEN_RANGE
    return (value > low) & (value < high)


def plausible_pressure(value: Column) -> Column:
    return value.between(*PRESSURE_CLOSED_RANGE)


RANGE_CHECKS: Mapping[str, Validity | None] = {
    TOPIC_TEMPERATURE: plausible_temperature,
    TOPIC_PRESSURE: plausible_pressure,
}


def _valid(checks: Mapping[str, Validity | None]) -> Column:
    """Topic-wise validity of ``measure``; a topic without a check accepts everything."""
    verdict = F.lit(True)
    for topic, check in checks.items():
        if check is not None:
            verdict = F.when(F.col("topic") == topic, check(F.col("measure"))).otherwise(verdict)
    return verdict


def _data(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == DATA)


def clean_readings(
    records: DataFrame,
    checks: Mapping[str, Validity | None] = RANGE_CHECKS,
    restamp: Column | None = None,
) -> DataFrame:
    """Raw topic records to valid readings, one narrow pass without a shuffle.

    ``restamp`` replaces the event time by that clock, at whole seconds; by default the time given
    by the sensor is kept.
    """
    typed = decode_typed_payload(_data(decode_and_route(records)))
    clean = typed.where(F.col("payload_ok") & _valid(checks))
    if restamp is not None:
        clean = clean.withColumn("event_time_text", rfc3339_seconds(restamp))
    return clean.drop("value", "type", "payload", "ingress_ts_nano", "has_marker", "malformed",
                      "route", "payload_ok")


def cleaned_records(
    records: DataFrame,
    checks: Mapping[str, Validity | None] = RANGE_CHECKS,
    restamp: Column | None = None,
) -> DataFrame:
    """The whole ingest stage on topic records, batch or streaming, in one pass over its source:
    valid readings re-encoded and keyed by sensor, markers unchanged, the rest dropped."""
    return cleaned_of(decode_readings(records), checks, restamp)


def cleaned_of(
    typed: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS, restamp: Column | None = None
) -> DataFrame:
    """``cleaned_records`` of records that are parsed already."""
    is_marker = F.col("route") == MARKER
    typed = typed.where(is_marker | (F.col("payload_ok") & _valid(checks)))
    if restamp is not None:
        typed = typed.withColumn("event_time_text", rfc3339_seconds(restamp))
    return typed.select(
        F.when(is_marker, F.col("key")).otherwise(F.col("sensor_id")).alias("key"),
        F.when(is_marker, F.col("value")).otherwise(reading_envelope()).alias("value"),
        F.lit(TOPIC_CLEANED).alias("topic"),
        "partition",
        "offset",
        "timestamp",
    )


def ingest_outcomes(
    records: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS
) -> DataFrame:
    """Every raw record with its ``outcome``: why it left the stream, or that it went on.

    Outcomes are ``malformed_envelope``, ``unhandled``, ``marker``, ``malformed_payload``,
    ``out_of_range`` and ``accepted``.
    """
    return outcomes_of(decode_readings(records), checks)


def outcomes_of(typed: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS) -> DataFrame:
    """``ingest_outcomes`` of records that are parsed already."""
    return typed.select("key", "value", "topic", "partition", "offset", "timestamp", _outcome(checks).alias("outcome"))


def _outcome(checks: Mapping[str, Validity | None]) -> Column:
    return (
        F.when(F.col("route") == MALFORMED, "malformed_envelope")
        .when(F.col("route") != DATA, F.col("route"))
        .when(~F.col("payload_ok"), "malformed_payload")
        .when(~_valid(checks), "out_of_range")
        .otherwise(ACCEPTED)
    )


def judged_of(typed: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS) -> DataFrame:
    """Every raw record with its ``outcome``, and with the one text that a stage still needs of it: accepted ones
    re-encoded and keyed by sensor, markers and rejects as they came. ``passed`` and ``rejected`` part them."""
    judged = typed.withColumn("outcome", _outcome(checks))
    accepted = F.col("outcome") == ACCEPTED
    return judged.select(
        F.when(accepted, F.col("sensor_id")).otherwise(F.col("key")).alias("key"),
        F.when(accepted, reading_envelope()).when(F.col("outcome") != UNHANDLED, F.col("value")).alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        "outcome",
    )


def passed(judged: DataFrame) -> DataFrame:
    """Of ``judged_of``: the records of the cleaned topic."""
    return judged.where(F.col("outcome").isin(ACCEPTED, MARKER)).drop("outcome").withColumn("topic", F.lit(TOPIC_CLEANED))


def rejected(judged: DataFrame) -> DataFrame:
    """Of ``judged_of``: the rejected records as they came, with the ``reason``."""
    return judged.where(F.col("outcome").isin(*REJECTED)).withColumnRenamed("outcome", "reason")


def rejects_of(typed: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS) -> DataFrame:
    """Rejected records as they came, with the ``reason``."""
    return outcomes_of(typed, checks).where(F.col("outcome").isin(*REJECTED)).withColumnRenamed("outcome", "reason")


def reject_reasons(
    records: DataFrame, checks: Mapping[str, Validity | None] = RANGE_CHECKS
) -> DataFrame:
    """Rejected records counted by topic and reason."""
    return (
        ingest_outcomes(records, checks)
        .where(F.col("outcome").isin(*REJECTED))
        .groupBy("topic", F.col("outcome").alias("reason"))
        .agg(F.count("*").alias("n"))
    )
