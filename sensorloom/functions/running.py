"""Running aggregates whose work is split inside a key.

A plain ``Window.partitionBy(key).orderBy(order)`` sends a whole key to one task. Here a key is cut
into chunks of its order's clock; each chunk is first reduced to one summary row (with map-side
partial aggregation), the summaries are scanned per key, and what they add up to *before* a chunk is
put in front of that chunk as one seed row. One window over (key, chunk) then yields the exact
global running value, no task holding more than one chunk of a key, at the price of one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.functions.times import bucket_number

_CHUNK, _SEED = "__chunk", "__seed"


@dataclass(frozen=True)
class Running:
    """One running value: ``op`` is ``max``, ``min``, ``sum`` or ``last`` (last non-null).

    ``inclusive=False`` looks only at the rows before the current one.
    """

    op: str
    expr: Column
    inclusive: bool = True

    def over(self, name: str, window) -> Column:
        if self.op == "last":
            return F.last(name, ignorenulls=True).over(window)
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.op](name).over(window)

    def summary(self, name: str, order: str) -> Column:
        """The value of a chunk. The order may be a struct."""
        if self.op == "last":
            return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order)))
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.op](name)


def with_running(
    df: DataFrame, keys: list[str], order: str, width: int, clock: Column | None = None, **values: Running
) -> DataFrame:
    """Add one column per entry of ``values``, running over ``keys`` by ``order``.

    ``order`` is a non-null column, unique within the key: a LONG, or a struct such as an arrival order.
    ``clock`` is a LONG that never falls along it (by default the order itself), and ``width`` the chunk size
    in its units: a hot key is as many chunks as it has such stretches of time. Small keys fit in one chunk and pay
    almost nothing. ``df`` is evaluated twice, so it should be a written table where it is costly.
    """
    inputs = {f"__in_{name}": value for name, value in values.items()}
    rows = df.withColumn(_CHUNK, bucket_number(F.col(order) if clock is None else clock, width))
    rows = rows.withColumns({name: value.expr for name, value in inputs.items()})

    groups = [*keys, _CHUNK]
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    summaries = rows.groupBy(*groups).agg(
        *[value.summary(name, order).alias(name) for name, value in inputs.items()]
    )
    seeds = summaries.select(
        *groups, *[value.over(name, before).alias(name) for name, value in inputs.items()]
    ).where(reduce(or_, [F.col(name).isNotNull() for name in inputs]))

    tagged = rows.withColumn(_SEED, F.lit(False)).unionByName(
        seeds.withColumn(_SEED, F.lit(True)), allowMissingColumns=True
    )
    # seeds carry a null order, and nulls sort first
    ordered = Window.partitionBy(*groups).orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.select(
            "*",
            *[
                value.over(f"__in_{name}", upto if value.inclusive else earlier).alias(name)
                for name, value in values.items()
            ],
        )
        .where(~F.col(_SEED))
        .drop(_CHUNK, _SEED, *inputs)
    )
