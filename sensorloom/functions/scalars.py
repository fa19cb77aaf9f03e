"""Scalar helpers over columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals by scaling, once, halves away from zero."""
    scale = float(10**digits)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def or_key(sensor_id: Column, key: Column) -> Column:
    """The sensor id, or the record key where the id is empty or missing."""
    return F.coalesce(F.nullif(sensor_id, F.lit("")), key.cast("string"))


def first_nonzero(temperature: Column, pressure: Column) -> Column:
    """Temperature unless it is missing or 0, else pressure, else 0.0."""
    warm = F.coalesce(temperature, F.lit(0.0))
    return F.when(warm != 0.0, warm).otherwise(F.coalesce(pressure, F.lit(0.0)))


def stable_id(*parts: Column) -> Column:
    """Deterministic message id: replaying the same row yields the same id."""
    return F.sha2(F.concat_ws("#", *[part.cast("string") for part in parts]), 256)


def through_float32(value: Column) -> Column:
    """The value as it looks after travelling in a 32-bit float field."""
    return value.cast("float").cast("double")
