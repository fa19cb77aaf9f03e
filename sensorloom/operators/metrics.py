"""Health metrics: counters, latency histograms and percentiles, trailing-range functions over
stored metric samples ``ts, metric, labels, value``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.constants import LATENCY_BOUNDS, MICROS, SEEDED_COUNTERS
from sensorloom.functions.arrival import ARRIVED
from sensorloom.functions.running import Running, with_running
from sensorloom.functions.times import micros

#: How long a gauge's last sample counts.
LOOKBACK_SECONDS = 300.0
_SERIES, _AT = "__series", "__at_us"


def count_outcomes(outcomes: DataFrame) -> DataFrame:
    """Events by ``type, status``; the four pre-registered pairs appear even at 0."""
    counts = outcomes.groupBy("type", "status").agg(F.count("*").alias("n"))
    zeros = [
        F.struct(F.lit(kind).alias("type"), F.lit(status).alias("status"), F.lit(0).cast("long").alias("n"))
        for kind, status in SEEDED_COUNTERS
    ]
    seeds = outcomes.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*zeros)))
    return counts.unionByName(seeds).groupBy("type", "status").agg(F.sum("n").alias("n"))


def latency_histogram(seconds_rows: DataFrame, seconds: str) -> DataFrame:
    """Cumulative bucket counts ``le, n`` plus ``total_seconds, total_n`` of all observations.

    Each observation is counted into its one bucket; only the sixteen counts are accumulated.
    """
    slot = reduce(add, [(F.col(seconds) > F.lit(b)).cast("int") for b in LATENCY_BOUNDS])
    labels = [repr(bound) for bound in LATENCY_BOUNDS] + ["+Inf"]
    totals = (
        seconds_rows.where(F.col(seconds).isNotNull())
        .select(slot.alias("slot"), seconds)
        .agg(
            *[F.count_if(F.col("slot") <= k).alias(f"b{k}") for k in range(len(labels))],
            F.coalesce(F.sum(seconds), F.lit(0.0)).alias("total_seconds"),
            F.count("*").alias("total_n"),
        )
    )
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("le"), F.col(f"b{k}").alias("n"))
            for k, label in enumerate(labels)
        ]
    )
    return totals.select(F.inline(rows), "total_seconds", "total_n")


def last_lag(rows: DataFrame, lag_seconds: Column, order: str = ARRIVED) -> DataFrame:
    """The processing-lag gauge: the last value set per sensor, in arrival order."""
    return (
        rows.select("sensor_id", order, lag_seconds.alias("__lag"))
        .groupBy("sensor_id")
        .agg(F.max_by("__lag", order).alias("lag_seconds"))
    )


def record_lag(now: Column, record_time: Column) -> Column:
    """Seconds since a record was written to its topic."""
    return (F.unix_micros(now) - F.unix_micros(record_time)) / F.lit(float(MICROS))


def event_lag(now: Column, event_time: Column) -> Column:
    """Seconds since an event, never negative."""
    return F.greatest(record_lag(now, event_time), F.lit(0.0))


def label(name: str) -> Column:
    return F.element_at("labels", name)


def _in_range(samples: DataFrame, metric: str | list[str], now: Column, seconds: float) -> DataFrame:
    """Samples of some metrics in ``(now - seconds, now]``, with a groupable series key."""
    start = F.timestamp_micros(F.unix_micros(now) - F.lit(micros(seconds)))
    names = [metric] if isinstance(metric, str) else metric
    return samples.where(
        F.col("metric").isin(*names) & (F.col("ts") > start) & (F.col("ts") <= now)
    ).withColumns(
        {
            _SERIES: F.to_json(F.array_sort(F.map_entries("labels"))),
            _AT: F.unix_micros("ts"),
        }
    )


def _named(by: Mapping[str, str] | list[str]) -> list[Column]:
    names = by if isinstance(by, Mapping) else {name: name for name in by}
    return [label(source).alias(name) for name, source in names.items()]


def _stepped(
    samples: DataFrame,
    metric: str | list[str],
    now: Column,
    seconds: float,
    chunk_seconds: float,
) -> DataFrame:
    """Samples in the range with ``__grown``, what each one added to its series."""
    stepped = with_running(
        _in_range(samples, metric, now, seconds),
        ["metric", _SERIES],
        _AT,
        micros(chunk_seconds),
        __previous=Running("last", F.col("value"), inclusive=False),
    )
    grown = F.when(F.col("__previous").isNull(), F.lit(0.0)).when(
        F.col("value") < F.col("__previous"), F.col("value")
    ).otherwise(F.col("value") - F.col("__previous"))
    return stepped.withColumn("__grown", grown)


def increase(
    samples: DataFrame,
    metric: str,
    by: list[str],
    now: Column,
    seconds: float,
    chunk_seconds: float = 86_400,
) -> DataFrame:
    """Growth of a counter over the trailing range, summed by labels: ``by..., increase``.

    A falling value is a restart from zero. Unlike a scraper's query language we do not extrapolate
    to the ends of the range.
    """
    stepped = _stepped(samples, metric, now, seconds, chunk_seconds)
    return stepped.groupBy(*_named(by)).agg(F.sum("__grown").alias("increase"))


def rate(
    samples: DataFrame,
    metric: str,
    by: list[str],
    now: Column,
    seconds: float,
    chunk_seconds: float = 86_400,
) -> DataFrame:
    """Growth per second over the trailing range, summed by labels: ``by..., rate``."""
    grown = increase(samples, metric, by, now, seconds, chunk_seconds)
    return grown.select(*by, (F.col("increase") / F.lit(float(seconds))).alias("rate"))


def mean_from_rates(
    samples: DataFrame, metric: str, by: list[str], now: Column, seconds: float
) -> DataFrame:
    """Mean observation of a histogram: growth of its sum over growth of its count, in one pass."""
    parts = [f"{metric}_sum", f"{metric}_count"]
    stepped = _stepped(samples, parts, now, seconds, 86_400)
    total, count = (F.sum(F.when(F.col("metric") == part, F.col("__grown"))) for part in parts)
    return stepped.groupBy(*_named(by)).agg(
        F.try_divide(total, F.nullif(count, F.lit(0.0))).alias("mean_seconds")
    )


def avg_over_time(
    samples: DataFrame, metric: str, by: list[str], now: Column, seconds: float
) -> DataFrame:
    """Mean of each series over the trailing range, summed by labels: ``by..., value``."""
    per_series = (
        _in_range(samples, metric, now, seconds)
        .groupBy(_SERIES, *_named(by))
        .agg(F.avg("value").alias("value"))
    )
    return per_series.groupBy(*by).agg(F.sum("value").alias("value"))


def latest_by(
    samples: DataFrame,
    metric: str,
    by: list[str],
    now: Column,
    how: str = "sum",
    lookback_seconds: float = LOOKBACK_SECONDS,
) -> DataFrame:
    """The last sample of each series up to ``now``, combined by labels with ``sum`` or ``max``.

    A series that sent nothing for ``lookback_seconds`` has no value any more. A series in which one of
    the labels ``by`` is missing or empty does not count.
    """
    matching = reduce(and_, [F.coalesce(label(name) != "", F.lit(False)) for name in by])
    per_series = (
        _in_range(samples, metric, now, lookback_seconds)
        .where(matching)
        .groupBy(_SERIES, *_named(by))
        .agg(F.max_by("value", _AT).alias("value"))
    )
    combine = {"sum": F.sum, "max": F.max}[how]
    return per_series.groupBy(*by).agg(combine("value").alias("value"))


#: Leading bits that a first range of values keeps, and parts that a range is cut into when it is opened.
LEADING_BITS, PARTS = 10, 4096


def _magnitude(value: Column) -> Column:
    """A number of the range that a LONG falls in: its sign, size and leading bits. Ranges keep the values' order,
    and there are no more than some 64,000 of them."""
    size = F.abs(value)
    bits = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))) + 1
    shift = F.greatest(bits - LEADING_BITS, F.lit(0)).cast("int")
    of = shift.cast("long") * (2 << LEADING_BITS) + F.call_function("shiftright", size, shift)
    return F.when(value < 0, -of).otherwise(of)


def value_at_ranks(values: DataFrame, name: str, ranks: Callable[[int], dict[str, int]]) -> tuple[dict[str, int], int]:
    """The values of the LONG column ``name`` at some ranks (from 0, nulls not counted), and how many there are.

    ``ranks`` gives the wanted ranks by label, from the number of values. Values are counted by range; only the
    ranges that hold a wanted rank are opened, cut into parts and counted again, until a range is one value. No
    task sorts values and none holds more than the counts of its ranges: two scans find any rank of values below
    2^32 or so, and each further one takes twelve more bits.
    """
    values = values.select(F.col(name).alias("v")).where(F.col(name).isNotNull())

    def counted(rows: DataFrame, *by: str) -> list:
        found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        return sorted((r["low"], r["high"], r["n"]) for r in found.collect())

    ranges = counted(values.withColumn("range", _magnitude(F.col("v"))), "range")
    total = sum(n for _, _, n in ranges)
    wanted = {label: rank for label, rank in ranks(total).items() if 0 <= rank < total}
    found: dict[str, int] = {}
    opened, held = [((None, None), 0, ranges)], {label: (rank, (None, None)) for label, rank in wanted.items()}
    while held:
        inside, before = {}, {}
        for of, base, parts in opened:
            for low, high, n in parts:
                for label, (rank, within) in held.items():
                    if within == of and base <= rank < base + n:
                        inside[label], before[low, high] = (rank, (low, high)), base
                base += n
        held = {label: x for label, x in inside.items() if x[1][0] < x[1][1]}
        found |= {label: low for label, (_, (low, high)) in inside.items() if low == high}
        open_ = sorted({within for _, within in held.values()})
        if open_:
            number, part = F.lit(None).cast("int"), F.lit(None).cast("long")
            for i, (low, high) in enumerate(open_):
                here, width = F.col("v").between(low, high), (high - low) // PARTS + 1
                number = F.when(here, i).otherwise(number)
                part = F.when(here, F.call_function("div", F.col("v") - low, F.lit(width))).otherwise(part)
            rows = values.select("v", number.alias("range"), part.alias("part")).where("range is not null")
            cut = counted(rows, "range", "part")
            opened = [(r, before[r], [c for c in cut if r[0] <= c[0] <= r[1]]) for r in open_]
    return found, total


#: Labels of the reported statistics and the share of values below each.
PERCENTILES = (("p50", 0.50), ("p95", 0.95), ("p99", 0.99))


def latency_percentiles(latencies: DataFrame) -> DataFrame:
    """Successful operations' p50, p95, p99 and maximum latency by exact rank ``floor(n * p)``
    from 0: ``statistic, latency_ms, n``."""

    def ranks(n: int) -> dict[str, int]:
        return {name: int(n * p) for name, p in PERCENTILES} | {"max": n - 1}

    found, n = value_at_ranks(latencies.where("ok"), "latency_ms", ranks)
    rows = [(name, value, n) for name, value in found.items()]
    return latencies.sparkSession.createDataFrame(rows, "statistic string, latency_ms long, n long")


def latency_summary(latencies: DataFrame) -> DataFrame:
    """Successes, failures and the truncated integer mean latency of the successes."""
    return latencies.agg(
        F.count_if("ok").alias("n_success"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.sum(F.when(F.col("ok"), F.col("latency_ms"))).alias("__total"),
    ).select(
        "n_success",
        "n_failed",
        F.when(
            F.col("n_success") > 0, F.call_function("div", F.col("__total"), F.col("n_success"))
        ).alias("mean_latency_ms"),
    )


def estimated_rate(groups: DataFrame) -> DataFrame:
    """Messages per second a set of sensor groups ``cnt, interval_sec`` emits."""
    return groups.where(F.col("interval_sec") > 0).agg(
        F.coalesce(F.sum(F.col("cnt") / F.col("interval_sec")), F.lit(0.0)).alias("rate")
    )
