"""Sliding windows as a keyed state machine for Structured Streaming.

One instance serves the sensors of a state partition. A sensor's rows of a micro-batch (readings
and lifecycle events) are put in arrival order and applied in runs between lifecycle events, with
array operations inside a run. Most sensors have few rows a batch, so rows come and go as rows: a
data frame per sensor would cost more than all else. The batch form of the same rules is ``operators.windows``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import Row, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorloom.constants import MICROS, READY, STOPPED, UNITS, WARM_UP
from sensorloom.operators.windows import WindowSpec

CLOCK = T.StructType(
    [
        T.StructField("max_us", T.LongType()),
        T.StructField("last_us", T.LongType()),
        T.StructField("stopped", T.BooleanType()),
        T.StructField("session_no", T.LongType()),
    ]
)
ITEM = T.StructType(
    [
        T.StructField("ts_us", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("max_us", T.LongType()),
    ]
)
OUTPUT = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("session_no", T.LongType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("window_start_us", T.LongType()),
        T.StructField("window_end_us", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("mean_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("std_dev", T.DoubleType()),
        T.StructField("rate_of_change", T.DoubleType()),
    ]
)
_NEVER = np.iinfo(np.int64).min // 2
#: Sums below this fit a LONG, however they were rounded.
_EXACT = 2.0**62
#: Columns of the arrival order, most significant first.
ORDER = ["at_us", "source", "partition", "offset"]
_WINDOW = Row(*OUTPUT.names)


def slope(seconds: np.ndarray, values: np.ndarray) -> float:
    """Least-squares slope, 0.0 where undefined."""
    centred = seconds - seconds.mean()
    spread = float(centred @ centred)
    return float(centred @ (values - values.mean())) / spread if spread > 0 else 0.0


def mean(values: np.ndarray) -> float:
    """``operators.windows.mean_of`` of an array: whole millionths where all values are such."""
    units = np.rint(values * UNITS)
    if np.abs(units).sum() < _EXACT and (units / UNITS == values).all():
        return int(units.astype(np.int64).sum()) / UNITS / len(values)
    return float(values.mean())


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """Rows by their order of arrival; a missing partition or offset sorts first."""
    batch = list(rows)
    places = [batch[0].__fields__.index(name) for name in ORDER]
    return sorted(batch, key=lambda row: [_NEVER if row[i] is None else row[i] for i in places])


class SlidingWindowProcessor(StatefulProcessor):
    """State per sensor: the event clock, the last evaluation, whether it is stopped, the buffer.

    The buffer is a list that is appended to. Items that the clock has left behind stay at its front, unread, until
    they are more than the live ones; only then, or when an event takes items out, is the list written anew.
    """

    def __init__(self, spec: WindowSpec = WindowSpec(), idle_ttl_ms: int | None = None) -> None:
        self.spec = spec
        self.idle_ttl_ms = idle_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clock = handle.getValueState("clock", CLOCK, self.idle_ttl_ms)
        self.buffer = handle.getListState("buffer", ITEM, self.idle_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        batch = _in_order(rows)
        at = {name: i for i, name in enumerate(batch[0].__fields__)}
        state_at, stop_at = at["state"], at["stop_us"]
        reading = [at[name] for name in ("ts_us", "value", "machine_id")]
        clock = self.clock.get()
        known = clock is not None
        max_us, last_us, stopped, session = clock if known else (None, None, False, 0)
        held = list(self.buffer.get()) if known else []
        buffer = tuple(
            np.array([item[i] for item in held], dtype=kind)
            for i, kind in enumerate((np.int64, np.float64, np.int64))
        )
        behind = 0 if max_us is None else int(np.searchsorted(buffer[2], max_us - self.spec.size_us))
        buffer = tuple(column[behind:] for column in buffer)
        intact = True  # the list in the state, without its front, begins the buffer

        out: list[tuple] = []
        for is_event, run in groupby(batch, key=lambda row: row[state_at] is not None):
            if not is_event:
                known = True
                if not stopped:
                    columns = zip(*[tuple(row[i] for i in reading) for row in run])
                    buffer, max_us, last_us, left = self._apply(
                        key[0], session, *columns, buffer, max_us, last_us, out
                    )
                    behind += left
            for row in run if is_event and known else ():
                state = row[state_at]
                if state == STOPPED:
                    stopped = True
                    stop = row[stop_at]
                    stays = buffer[0] <= stop if stop is not None else np.zeros(len(buffer[0]), bool)
                    intact = intact and bool(stays.all())
                    buffer = tuple(column[stays] for column in buffer)
                elif state == WARM_UP:
                    session += 1
                    max_us = last_us = None
                    intact = False
                    buffer = tuple(column[:0] for column in buffer)
                elif state == READY:
                    stopped = False

        if known:
            self.clock.update((max_us, last_us, stopped, session))
            self._keep(buffer, len(held), behind, intact)
        yield from (_WINDOW(*window) for window in out)

    def _keep(self, buffer, stored: int, behind: int, intact: bool) -> None:
        """Bring the list state up to the buffer; ``behind`` items of its front are left behind by now."""
        live = len(buffer[0])
        append = intact and behind <= max(live, stored - behind)
        fresh = max(0, stored - behind) if append else 0
        items = [(int(t), float(v), int(m)) for t, v, m in zip(*(column[fresh:] for column in buffer))]
        if append and items:
            self.buffer.appendList(items)
        elif not append and live:
            self.buffer.put(items)
        elif not append:
            self.buffer.clear()

    def _apply(self, sensor, session, ts, values, machines, buffer, max_us, last_us, out):
        """Readings between two lifecycle events: returns the new buffer and clock, and how many items it left."""
        spec = self.spec
        ts = np.array(ts, dtype=np.int64)
        before = _NEVER if max_us is None else max_us
        clock = np.maximum(np.maximum.accumulate(ts), before)
        earlier = np.append(before, clock[:-1])
        kept = ts >= clock - spec.lateness_us
        raises = (ts > earlier)[kept]
        machines = [machine for machine, stays in zip(machines, kept.tolist()) if stays]

        offset = len(buffer[0])
        fresh = (ts[kept], np.array(values, dtype=np.float64)[kept], clock[kept])
        times, values, seen = (np.concatenate(pair) for pair in zip(buffer, fresh))
        at = np.flatnonzero(raises)
        maxima = fresh[2][at]
        here = 0 if last_us is None else int(np.searchsorted(maxima, last_us + spec.slide_us))
        while here < len(at):
            end_us = last_us = int(maxima[here])
            low = int(np.searchsorted(seen, end_us - spec.size_us))
            high = offset + int(at[here]) + 1
            member = values[low:high]
            seconds = (times[low:high] - end_us) / MICROS
            out.append(
                (sensor, session, machines[at[here]], end_us - spec.size_us, end_us, len(member),
                 float(member.min()), mean(member), float(member.max()), float(member.std()), slope(seconds, member))
            )
            here += int(np.searchsorted(maxima[here:], end_us + spec.slide_us))
        max_us = int(clock[-1])
        low = int(np.searchsorted(seen, max_us - spec.size_us))
        return (times[low:], values[low:], seen[low:]), max_us, last_us, low

    def close(self) -> None:
        pass
