"""Sensor lifecycle: parsing, as-of state, acceptance gate, sessions, purges and intervals.

A sensor is stopped from a STOPPED event until the next READY; a WARM-UP starts a new session with
an empty window. Events reaching a sensor before its first reading have no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.constants import MICROS, READY, STOPPED, WARM_UP
from sensorloom.functions.arrival import ARRIVED, arrival_us
from sensorloom.functions.running import Running, with_running
from sensorloom.functions.times import bucket_number
from sensorloom.operators.points import last_write_wins
from sensorloom.operators.windows import WindowSpec, windows_of, with_event_clock
from sensorloom.session import written


def parse_lifecycle(messages: DataFrame) -> DataFrame:
    """``message`` (``id:STATE``) to ``sensor_id, state``; anything but two parts is ignored."""
    parts = F.split("message", ":")
    return (
        messages.withColumn("__p", parts)
        .where(F.size("__p") == 2)
        .select(
            F.col("__p")[0].alias("sensor_id"),
            F.col("__p")[1].alias("state"),
            *[name for name in messages.columns if name != "message"],
        )
    )


def _heard(readings: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Lifecycle events that find their sensor already known."""
    known = readings.groupBy("sensor_id").agg(F.min(ARRIVED).alias("__first"))
    return (
        lifecycle.join(known, "sensor_id").where(F.col(ARRIVED) > F.col("__first")).drop("__first")
    )


def _state_values() -> dict[str, Running]:
    state = F.col("__state")
    return {
        "state": Running("last", state),
        "session_no": Running("sum", F.when(state == WARM_UP, 1).cast("long")),
        "__flow": Running("last", F.when(state.isin(STOPPED, READY), state)),
    }


def _merged(readings: DataFrame, lifecycle: DataFrame, chunk_us: int) -> DataFrame:
    """Readings and the lifecycle events they hear, each with the state in force from it on:
    ``state, session_no, stopped`` and ``is_event``.

    Both kinds are written as one table first, which the running values read twice.
    """
    tagged = readings.withColumns({"__state": F.lit(None).cast("string"), "is_event": F.lit(False)})
    heard = _heard(readings, lifecycle).withColumns(
        {"__state": F.col("state"), "is_event": F.lit(True)}
    )
    heard = heard.drop("state", *set(heard.columns) & {"machine_id", "value", "ts"})
    merged = written(tagged.unionByName(heard, allowMissingColumns=True), "heard")
    states = with_running(merged, ["sensor_id"], ARRIVED, chunk_us, arrival_us(), **_state_values())
    return states.select(
        *[name for name in merged.columns],
        "state",
        F.coalesce("session_no", F.lit(0)).alias("session_no"),
        F.coalesce(F.col("__flow") == STOPPED, F.lit(False)).alias("stopped"),
    )


def with_lifecycle(
    readings: DataFrame, lifecycle: DataFrame, chunk_us: int = WindowSpec().chunk_us
) -> DataFrame:
    """Readings with the lifecycle in force on their arrival: ``state`` (null before the first
    event), ``session_no`` and ``stopped``.

    Both frames need ``sensor_id`` and ``arrived``, on one arrival order over all their sources.
    """
    merged = _merged(readings, lifecycle.select("sensor_id", "state", ARRIVED), chunk_us)
    return merged.where(~F.col("is_event")).select(
        *readings.columns, "state", "session_no", "stopped"
    )


def accepted(
    readings: DataFrame, lifecycle: DataFrame, chunk_us: int = WindowSpec().chunk_us
) -> DataFrame:
    """Readings of running sensors with their ``session_no``."""
    return (
        with_lifecycle(readings, lifecycle, chunk_us)
        .where(~F.col("stopped"))
        .select(*readings.columns, "session_no")
    )


KEYS = ["sensor_id", "session_no"]


def _buffered(readings: DataFrame, lifecycle: DataFrame, spec: WindowSpec) -> DataFrame:
    """Readings that enter a buffer and the stops, written, each with the event clock of its session."""
    events = lifecycle.select("sensor_id", "state", ARRIVED, "stop_ts")
    merged = _merged(readings, events, spec.chunk_us)
    relevant = merged.where(
        F.when(F.col("is_event"), F.col("__state") == STOPPED).otherwise(~F.col("stopped"))
    ).select(*KEYS, ARRIVED, "machine_id", "ts", "value", "stop_ts", "is_event")
    clocked = with_event_clock(written(relevant, "relevant"), KEYS, spec)
    clocked = clocked.where(F.col("is_event") | ~F.col("is_late")).drop("ts", "watermark_us", "is_late")
    return written(clocked.withColumn("__b", bucket_number(F.col("max_us"), spec.size_us)), "clocked")


def _with_stops(clocked: DataFrame, spec: WindowSpec, how: str) -> DataFrame:
    """Items with ``__met``, the stops that find them in the buffer in order of arrival, and for each of these
    whether it lets the item stay (``__stays``), and the number of the first that does not (``__gone``, or 0).

    An item is in the buffer from its arrival until the event clock leaves it a window behind, or until the
    first stop that purges it. So an item looks up the stops of the two stretches of the event clock in which it
    can live and folds them in order: one equi-join, no pairs of items.
    """
    stop = F.struct(ARRIVED, F.col("max_us").alias("at_us"), F.unix_micros("stop_ts").alias("stop_us"))
    # A stop is looked up from its own stretch and the one before. Arrays are per stretch of a session.
    probes = clocked.where("is_event and max_us is not null").select(
        *KEYS, F.explode(F.array("__b", F.col("__b") - 1)).alias("__b"), stop.alias("stop")
    )
    probes = probes.groupBy(*KEYS, "__b").agg(F.array_sort(F.collect_list("stop")).alias("__stops"))
    met = F.filter(
        "__stops",
        lambda s: (s[ARRIVED] > F.col(ARRIVED)) & (s["at_us"] <= F.col("max_us") + F.lit(spec.size_us)),
    )
    stays = F.transform("__met", lambda s: F.coalesce(F.col("ts_us") <= s["stop_us"], F.lit(False)))
    items = clocked.where(~F.col("is_event")).join(probes, [*KEYS, "__b"], how).drop("__b")
    items = items.withColumn("__met", met).withColumn("__stays", stays)
    return items.withColumn("__gone", F.array_position("__stays", F.lit(False)).cast("int")).drop("__stops")


def stop_purges(
    readings: DataFrame, lifecycle: DataFrame, spec: WindowSpec = WindowSpec()
) -> DataFrame:
    """What each STOPPED event leaves of the sensor's buffer: ``sensor_id, session_no, arrived, stop_ts,
    n_kept, n_purged``.

    A stop keeps buffered items with ``ts <= stop_ts``; a stop without a readable time keeps none.
    ``lifecycle`` carries ``stop_ts``. Every item counts for each stop up to the first that purges it.
    """
    clocked = _buffered(readings, lifecycle, spec)
    alive = F.when(F.col("__gone") > 0, F.col("__gone")).otherwise(F.size("__met"))
    fates = (
        _with_stops(clocked, spec, "inner")
        .where(F.size("__met") > 0)
        .select(*KEYS, F.explode(F.slice(F.arrays_zip("__met", "__stays"), F.lit(1), alive)).alias("fate"))
        .groupBy(*KEYS, F.col(f"fate.__met.{ARRIVED}").alias(ARRIVED))
        .agg(F.count_if("fate.__stays").alias("n_kept"), F.count_if(~F.col("fate.__stays")).alias("n_purged"))
    )
    return clocked.where("is_event").join(fates, [*KEYS, ARRIVED], "left").select(
        *KEYS,
        ARRIVED,
        "stop_ts",
        F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
        F.coalesce("n_purged", F.lit(0)).alias("n_purged"),
    )


def session_windows(
    readings: DataFrame, lifecycle: DataFrame, spec: WindowSpec = WindowSpec()
) -> DataFrame:
    """The sliding windows of running sensors by session, as the streaming stage makes them: warm-ups empty the
    buffer, stops purge it. ``lifecycle`` carries ``stop_ts``."""
    items = _with_stops(_buffered(readings, lifecycle, spec), spec, "left")
    gone = F.get(F.transform("__met", lambda s: s["at_us"]), F.col("__gone") - 1)
    items = items.withColumn("gone_us", F.when(F.col("__gone") > 0, gone))
    kept = items.select(*KEYS, "machine_id", "ts_us", "value", "max_us", "is_new_max", "gone_us", ARRIVED)
    return windows_of(written(kept, "kept"), KEYS, spec)


def latest_status(lifecycle: DataFrame) -> DataFrame:
    """The current status per sensor, by the last lifecycle event to arrive."""
    events = lifecycle.select("sensor_id", "machine_id", F.col("state").alias("status"), ARRIVED)
    return last_write_wins(events, ["sensor_id"], ARRIVED).drop(ARRIVED)


def state_intervals(lifecycle: DataFrame, chunk_us: int = WindowSpec().chunk_us) -> DataFrame:
    """Time spent in each state: ``sensor_id, state, start_ts, end_ts, seconds``; the running
    state of a sensor has no end yet."""
    back = F.struct(
        (-arrival_us()).alias("at"), *[(-F.col(f"{ARRIVED}.{f}")).alias(f) for f in ("source", "partition", "offset")]
    )
    following = with_running(
        lifecycle.withColumn("__back", back),
        ["sensor_id"],
        "__back",
        chunk_us,
        -arrival_us(),
        end_ts=Running("last", F.col("event_ts"), inclusive=False),
    )
    span: Column = F.unix_micros("end_ts") - F.unix_micros("event_ts")
    return following.select(
        "sensor_id",
        "state",
        F.col("event_ts").alias("start_ts"),
        "end_ts",
        (span / F.lit(float(MICROS))).alias("seconds"),
    )
