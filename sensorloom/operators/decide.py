"""The decision stage: configuration lookup, threshold rules, alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom import schemas
from sensorloom.constants import COMMAND_STOP, TYPE_DATA, TYPE_MARKER, TYPE_UNHANDLED
from sensorloom.functions.arrival import ARRIVED, record_arrival
from sensorloom.operators.codec import DATA, MALFORMED, MARKER, UNHANDLED, parse_once, unusable
from sensorloom.operators.points import last_write_wins

LIMITS = ("min_threshold", "max_threshold", "max_std_dev", "max_drift")
OUT_OF_RANGE, UNSTABLE, DRIFT = "out_of_range", "instability", "drift"


def with_config(windows: DataFrame, config: DataFrame) -> DataFrame:
    """Windows with their sensor's limits and ``has_config``.

    One left join serves hits and misses. No broadcast hint: the table grows with the fleet, so
    Spark picks a broadcast by its measured size and otherwise a sort-merge join, whose skewed
    partitions adaptive execution splits.
    """
    limits = config.select("sensor_id", *LIMITS, F.lit(True).alias("has_config"))
    return windows.join(limits, "sensor_id", "left").withColumn(
        "has_config", F.coalesce("has_config", F.lit(False))
    )


def missing_config(windows: DataFrame, config: DataFrame) -> DataFrame:
    """Windows whose sensor has no configuration."""
    return windows.join(config.select("sensor_id"), "sensor_id", "left_anti")


def rule_code(compat: str = "intended") -> Column:
    """The first rule a window breaks, or null.

    ``compat="as_written"`` reproduces deployments in which the deviation limit never arrives (it
    is written and read under different keys), so that its rule never fires.
    """
    if compat not in ("intended", "as_written"):
        raise ValueError(f"unknown compat mode: {compat}")
    max_std_dev = F.col("max_std_dev") if compat == "intended" else F.lit(0.0)
    mean = F.col("mean_value")
    return (
        F.when(
            (mean < F.col("min_threshold")) | (mean > F.col("max_threshold")), F.lit(OUT_OF_RANGE)
        )
        .when((max_std_dev > 0) & (F.col("std_dev") > max_std_dev), F.lit(UNSTABLE))
        .when(
            (F.col("max_drift") > 0) & (F.abs("rate_of_change") > F.col("max_drift")), F.lit(DRIFT)
        )
    )


def reason_text() -> Column:
    """A readable reason for ``rule_code``."""
    return (
        F.when(
            F.col("rule_code") == OUT_OF_RANGE,
            F.format_string(
                "mean %.2f outside [%.2f, %.2f]",
                F.col("mean_value"), F.col("min_threshold"), F.col("max_threshold"),
            ),
        )
        .when(
            F.col("rule_code") == UNSTABLE,
            F.format_string(
                "standard deviation %.2f above %.2f", F.col("std_dev"), F.col("max_std_dev")
            ),
        )
        .when(
            F.col("rule_code") == DRIFT,
            F.format_string(
                "drift %.4f above %.4f", F.abs("rate_of_change"), F.col("max_drift")
            ),
        )
    )


def evaluate_rules(enriched: DataFrame, compat: str = "intended") -> DataFrame:
    """Configured windows with ``rule_code, reason, is_anomaly``."""
    judged = enriched.where("has_config").withColumn("rule_code", rule_code(compat))
    return judged.withColumns(
        {"reason": reason_text(), "is_anomaly": F.col("rule_code").isNotNull()}
    )


def alarms(judged: DataFrame) -> DataFrame:
    """One stop command per anomalous window, without debouncing."""
    return judged.where("is_anomaly").select(
        "sensor_id", F.lit(COMMAND_STOP).alias("command"), "window_end"
    )


def encode_alarms(alarm_rows: DataFrame) -> DataFrame:
    """Alarms as signal-topic records keyed by sensor; other columns go along."""
    body = F.struct(F.col("sensor_id").alias("sensorId"), "command")
    rest = [name for name in alarm_rows.columns if name not in ("sensor_id", "command")]
    return alarm_rows.select(F.col("sensor_id").alias("key"), F.to_json(body).alias("value"), *rest)


def decode_commands(records: DataFrame) -> DataFrame:
    """Signal-topic records as ``sensor_id, command, partition, offset``; malformed ones are skipped."""
    parsed = parse_once(records, __a=(F.col("value"), schemas.ALARM))
    return parsed.where(~unusable("__a")).select(
        "key",
        F.coalesce("__a.sensorId", F.lit("")).alias("sensor_id"),
        F.coalesce("__a.command", F.lit("")).alias("command"),
        "partition",
        "offset",
    )


def stop_commands(records: DataFrame) -> DataFrame:
    """The only commands acted on: stops."""
    return decode_commands(records).where(F.col("command") == COMMAND_STOP)


def compacted(records: DataFrame) -> DataFrame:
    """Log compaction: the last record per key, in arrival order."""
    keyed = records.select("key", "value", record_arrival())
    return last_write_wins(keyed, ["key"], ARRIVED)


def decision_outcomes(records: DataFrame, config: DataFrame) -> DataFrame:
    """``type, status`` of every processed-topic record, as the stage counts them.

    ``records`` are all rows, decoded once (``decode_processed_all``); malformed envelopes are not
    counted.
    """
    looked_up = F.when(F.col("payload_ok"), F.col("sensor_id"))
    keyed = records.select("route", "payload_ok", looked_up.alias("sensor_id"))
    return enriched_outcomes(with_config(keyed, config))


def enriched_outcomes(enriched: DataFrame) -> DataFrame:
    """``decision_outcomes`` of rows that are joined with the configuration already."""
    return _outcomes(
        enriched,
        F.when(~F.col("payload_ok"), "unmarshal_payload_error")
        .when(F.col("has_config"), "success")
        .otherwise("redis_config_missing"),
    )


def decision_rejects(enriched: DataFrame) -> DataFrame:
    """Records of the processed topic that the stage gives up, as they came, with the ``reason``.

    ``enriched`` are all rows, decoded once and joined with the configuration.
    """
    return rejected(enriched.withColumn("reason", reject_reason()))


def reject_reason() -> Column:
    """Why the stage gives a record up, or null."""
    return (
        F.when(F.col("route") == MALFORMED, "malformed_envelope")
        .when((F.col("route") == DATA) & ~F.col("payload_ok"), "unmarshal_payload_error")
        .when((F.col("route") == DATA) & ~F.col("has_config"), "redis_config_missing")
    )


def rejected(named: DataFrame) -> DataFrame:
    """Of records with their ``reject_reason`` as ``reason`` those that have one."""
    return named.where("reason is not null").select("key", "value", "topic", "partition", "offset", "timestamp", "reason")


def sink_outcomes(records: DataFrame) -> DataFrame:
    """``type, status`` of every processed-topic record, as the metrics sink counts them."""
    counted = records.where(F.col("route").isin(DATA, MARKER))
    return _outcomes(counted, F.when(F.col("payload_ok"), "success").otherwise("error"))


def _outcomes(records: DataFrame, of_data: Column) -> DataFrame:
    route = F.col("route")
    kind = F.when(route == MARKER, TYPE_MARKER).when(route == DATA, TYPE_DATA).otherwise(TYPE_UNHANDLED)
    status = F.when(route == MARKER, "success").when(route == DATA, of_data).otherwise("ignored")
    return records.where(route.isin(DATA, MARKER, UNHANDLED)).select(
        kind.alias("type"), status.alias("status")
    )
