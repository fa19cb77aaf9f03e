"""The slide gate: which running maxima of a sensor's event time trigger an evaluation.

The first maximum does; after that each one at least ``slide`` after the last that did. That is a
chain over the maxima of one sensor, sequential by nature, and built-in functions cannot carry it,
so it runs in small numpy steps inside tasks. To keep a hot sensor from being one task, its time
axis is cut into stretches, and what the chain does within a stretch becomes a map from where it can
*enter* to where it then *leaves*. Such maps compose, so they are built in levels:

1. up: per stretch of ``fan_out`` slides, in parallel, every maximum at which the chain could enter
   (only the first slide of a stretch holds such) with its exit. The same step over these rows gives
   the maps of stretches ``fan_out`` times as wide, and so on until no sensor has more than
   ``serial_rows`` rows;
2. top: the chain of each sensor hops over its widest stretches, streamed with constant memory;
3. down: per stretch of each level, in parallel, the chain from its now known entry names the
   entries of the stretches below, and at last the maxima themselves.

A sensor of n maxima takes about log(n / ``serial_rows``) / log(``fan_out``) levels, each over a
``fan_out``-th of the rows of the one below, and no task walks more than one stretch of a level. A
level can't shrink below the maxima of one slide, as each of them may be an entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from sensorloom.functions.times import bucket_number
from sensorloom.session import written

_STRETCH = "__stretch"
_EXIT = "__exit"
_FROM = "__from"

#: Rows of one sensor that one task may hop over at the top.
SERIAL_ROWS = 1 << 16
#: Stretches are no wider than this, half of what a LONG holds.
_WIDEST_US = 1 << 62


def _changes(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """True where a new key starts, the first row included."""
    fresh = np.zeros(len(rows), dtype=bool)
    fresh[:1] = True
    for key in keys:
        column = rows[key].to_numpy()
        fresh[1:] |= column[1:] != column[:-1]
    return fresh


def _starts_anew(before: pd.DataFrame, after: pd.DataFrame, keys: list[str]) -> bool:
    return any(before[key].iloc[-1] != after[key].iloc[0] for key in keys)


def _chain(keys: list[str], at: str, leave: str, slide_us: int) -> Callable:
    """Batches sorted by ``keys, at`` in, the rows the chain of each key visits out.

    After a visited row the chain is due ``slide_us`` after that row's ``leave``.
    """

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, due = None, None
        for batch in batches:
            at_us, leave_us = batch[at].to_numpy(), batch[leave].to_numpy()
            columns = [batch[key].to_numpy() for key in keys]
            edges = [*np.flatnonzero(_changes(batch, keys)), len(batch)]
            visited: list[int] = []
            for start, end in zip(edges, edges[1:]):
                key = tuple(column[start] for column in columns)
                if key != current:
                    current, due = key, None
                here = start
                if due is not None:
                    here += int(np.searchsorted(at_us[start:end], due))
                while here < end:
                    visited.append(here)
                    due = int(leave_us[here]) + slide_us
                    here += int(np.searchsorted(at_us[here:end], due))
            yield batch.iloc[visited]

    return visit


def _entries(keys: list[str], at: str, slide_us: int, stretch_us: int) -> Callable:
    """Batches sorted by ``keys`` (stretch number last) and ``at`` in; out come the rows at which
    the chain can enter each stretch, with the exit it then takes.

    A row of the batch stands for the chain from ``at`` to its own exit. All whole stretches of a
    batch are handled at once; an unfinished last stretch waits for the next batch.
    """

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        at_us, exit_us = rows[at].to_numpy(), rows[_EXIT].to_numpy()
        fresh = _changes(rows, keys)
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        last = np.append(first[1:], len(rows))[group] - 1
        # Stretches laid end to end on an axis of ranks, which no span of time can overflow.
        times = np.unique(at_us)
        offset = group * (len(times) + 1)
        axis = offset + np.searchsorted(times, at_us)
        due = offset + np.searchsorted(times, exit_us + slide_us)

        here = np.arange(len(rows))
        hop = np.searchsorted(axis, due)
        hop = np.where(hop <= last, hop, here)
        while not np.array_equal(hop, hop[hop]):
            hop = hop[hop]
        beyond = at_us - rows[_STRETCH].to_numpy() * stretch_us >= slide_us
        follows_beyond = np.append(False, beyond[:-1]) & ~fresh
        possible = ~(beyond & follows_beyond)
        return rows[possible].assign(**{_EXIT: exit_us[hop[possible]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            whole = int(np.flatnonzero(_changes(batch, keys))[-1])
            if waiting and (whole or _starts_anew(waiting[-1], batch, keys)):
                yield follow(pd.concat([*waiting, batch.iloc[:whole]], ignore_index=True))
                waiting = []
            elif whole:
                yield follow(batch.iloc[:whole].reset_index(drop=True))
            waiting.append(batch.iloc[whole:])
        if waiting:
            yield follow(pd.concat(waiting, ignore_index=True))

    return run


def _hottest(rows: DataFrame, keys: list[str], bound: int) -> int:
    """Rows of the key that has most, or of all keys if those are within ``bound``."""
    total = rows.count()
    if total <= bound:
        return total
    return rows.groupBy(*keys).count().agg(F.max("count")).first()[0]


def stretch_maps(
    maxima: DataFrame, keys: list[str], at: str, slide_us: int, fan_out: int, serial_rows: int
) -> list[tuple[int, DataFrame]]:
    """The levels above ``maxima``: the width of their stretches and their written entry rows
    (``keys``, stretch number, ``at``, exit)."""
    levels: list[tuple[int, DataFrame]] = []
    width, most = slide_us * fan_out, None
    rows = maxima.select(*keys, at, F.col(at).alias(_EXIT))
    while True:
        stretch_keys = [*keys, _STRETCH]
        cut = rows.withColumn(_STRETCH, bucket_number(F.col(at), width)).select(*stretch_keys, at, _EXIT)
        entries = (
            cut.repartition(*stretch_keys)
            .sortWithinPartitions(*stretch_keys, at)
            .mapInPandas(_entries(stretch_keys, at, slide_us, width), cut.schema)
        )
        levels.append((width, written(entries, "gate-entries")))
        rows, before = levels[-1][1], most
        most = _hottest(rows, keys, serial_rows)
        if most <= serial_rows or most == before or width * fan_out > _WIDEST_US:
            return levels
        width *= fan_out


def _within(
    rows: DataFrame, entered: DataFrame, keys: list[str], at: str, leave: str, slide_us: int, width: int
) -> DataFrame:
    """The ``rows`` that the chain visits, given where it ``entered`` each stretch of ``width``."""
    stretch_keys = [*keys, _STRETCH]
    cut = rows.withColumn(_STRETCH, bucket_number(F.col(at), width))
    known = entered.select(*stretch_keys, F.col(at).alias(_FROM))
    return (
        cut.join(known, stretch_keys)
        .where(F.col(at) >= F.col(_FROM))
        .select(cut.columns)
        .repartition(*stretch_keys)
        .sortWithinPartitions(*stretch_keys, at)
        .mapInPandas(_chain(stretch_keys, at, leave, slide_us), cut.schema)
    )


def evaluation_points(
    maxima: DataFrame,
    keys: list[str],
    at: str,
    slide_us: int,
    fan_out: int = 64,
    serial_rows: int = SERIAL_ROWS,
) -> DataFrame:
    """The rows of ``maxima`` (one per key and new maximum ``at``, a LONG) that open the gate.

    ``maxima`` is evaluated twice, so it should be a written table where it is costly.
    """
    levels = stretch_maps(maxima, keys, at, slide_us, fan_out, serial_rows)
    top = levels[-1][1]
    entered = (
        top.repartition(*keys)
        .sortWithinPartitions(*keys, at)
        .mapInPandas(_chain(keys, at, _EXIT, slide_us), top.schema)
    )
    for (width, _), (below, rows) in zip(levels[:0:-1], levels[-2::-1]):
        lower = _within(rows.drop(_STRETCH), entered, keys, at, _EXIT, slide_us, width)
        entered = lower.withColumn(_STRETCH, bucket_number(F.col(at), below))
    return _within(maxima, entered, keys, at, at, slide_us, levels[0][0]).select(maxima.columns)
