"""The arrival order of records that come from several sources and partitions.

An offset orders the records of one partition only. Across partitions and topics records are ordered by
the time they were recorded, then by source, partition and offset: a total order, as no two records share the
last three. It travels as one struct column, ``arrived``, which Spark sorts and aggregates field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom.constants import SOURCES

ARRIVED = "arrived"
ORDER = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("source", T.IntegerType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def arrival(at: Column, source: Column | int, partition: Column, offset: Column) -> Column:
    """The order of one record; a missing partition or offset sorts first."""
    values = (at, F.lit(source) if isinstance(source, int) else source, partition, offset)
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, ORDER, strict=True)]).alias(ARRIVED)


def source_rank(topic: Column) -> Column:
    """Rank of a topic among the sources: lifecycle events before readings of the same instant."""
    rank = F.lit(len(SOURCES))
    for number, name in enumerate(SOURCES):
        rank = F.when(topic == name, number).otherwise(rank)
    return rank


def record_arrival() -> Column:
    """The order of a topic record, from its Kafka columns."""
    return arrival(F.col("timestamp"), source_rank(F.col("topic")), F.col("partition"), F.col("offset"))


def arrival_us(order: str = ARRIVED) -> Column:
    """The clock of the arrival order: microseconds of the record time."""
    return F.unix_micros(F.col(f"{order}.at"))


def spread(frame: DataFrame, order: str = ARRIVED) -> DataFrame:
    """``frame`` with the order's fields as columns ``recorded, source, partition, offset`` in its place."""
    fields = [F.col(f"{order}.{f.name}").alias("recorded" if f.name == "at" else f.name) for f in ORDER]
    return frame.select(*[c for c in frame.columns if c != order], *fields)
