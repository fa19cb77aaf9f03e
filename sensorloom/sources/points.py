"""Time-series point tables on Parquet: atomic idempotent batch appends, last write wins on read.

A point is identified by its tags and its time. A micro-batch writes the days it touches into a folder of its own
and makes them visible in one commit (``sources.commits``): readers never see a part of a batch, a replayed batch
changes nothing, and one that broke on the way is written anew. Batch ids start at 0 with every checkpoint, so each
checkpoint needs a writer name of its own. Readers keep the last arrival per point. ``compact`` folds the batches of
closed days and ``retain`` drops old days, both in place and in one commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions.arrival import ARRIVED, ORDER
from sensorloom.functions.times import micros
from sensorloom.operators.points import last_write_wins
from sensorloom.sources.commits import CommitLog

#: Tasks that write one day of a compacted table.
SLICES = 64


@dataclass(frozen=True)
class PointTable:
    """A point table below ``path`` with identity ``tags`` + ``ts`` and the given value columns."""

    path: str
    tags: tuple[str, ...]
    fields: tuple[str, ...]

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path)

    @property
    def schema(self) -> T.StructType:
        columns = [T.StructField(tag, T.StringType()) for tag in self.tags]
        columns += [T.StructField(name, T.DoubleType()) for name in self.fields]
        columns += [
            T.StructField("ts", T.TimestampType()),
            T.StructField(ARRIVED, ORDER),
            T.StructField("day", T.DateType()),
        ]
        return T.StructType(columns)

    def append(self, points: DataFrame, batch_id: int, writer: str) -> None:
        """Write one micro-batch, once: the same writer and id again change nothing.

        Rows of a day are dealt to few tasks first, so that a batch leaves few files a day.
        """
        spark = points.sparkSession

        def write(folder: str) -> dict:
            rows = points.select(*self.tags, *self.fields, "ts", ARRIVED, F.to_date("ts").alias("day"))
            rows.hint("rebalance", "day").write.partitionBy("day").parquet(folder)
            return self._days(spark, folder)

        self.log.append(spark, writer, batch_id, write)

    def _days(self, spark: SparkSession, folder: str) -> dict:
        names = [n for n in self.log.inner(spark, folder) if n.startswith("day=")]
        return {name: {"day": name.removeprefix("day=")} for name in names}

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*self.log.paths(folders)).select(*[f.name for f in self.schema])

    def scan(self, spark: SparkSession, since: Column | None = None) -> DataFrame:
        """Every stored row of the present snapshot. ``since`` (a TIMESTAMP) prunes day partitions and row groups."""
        rows = self._rows(spark, list(self.log.snapshot(spark).folders))
        if since is not None:
            rows = rows.where((F.col("ts") >= since) & (F.col("day") >= F.to_date(since)))
        return rows

    def read(self, spark: SparkSession, since: Column | None = None) -> DataFrame:
        """The current points: the last write per tags and time."""
        return last_write_wins(self.scan(spark, since).drop("day"), [*self.tags, "ts"], ARRIVED)

    def _before(self, spark: SparkSession, at: Column) -> dict[str, list[str]]:
        """Live folders of the days before that of ``at``, by day."""
        first = spark.range(1).select(F.date_format(at, "yyyy-MM-dd")).first()[0]
        days: dict[str, list[str]] = {}
        for folder, holds in self.log.snapshot(spark).folders.items():
            if holds["day"] < first:
                days.setdefault(holds["day"], []).append(folder)
        return days

    def compact(self, spark: SparkSession, before: Column) -> None:
        """Fold the batches of each day before that of ``before`` into one. Other days aren't touched, nor are
        days that one batch made."""
        folders = [f for found in self._before(spark, before).values() if len(found) > 1 for f in found]

        def write(folder: str) -> dict:
            rows = last_write_wins(self._rows(spark, folders), [*self.tags, "ts", "day"], ARRIVED)
            rows = rows.repartition("day", F.pmod(F.hash(*self.tags), F.lit(SLICES)))
            rows.write.partitionBy("day").parquet(folder)
            return self._days(spark, folder)

        if folders:
            self.log.replace(spark, folders, write)

    def retain(self, spark: SparkSession, now: Column, hours: float) -> None:
        """Drop the days that are older than ``hours`` as a whole: no file is read or written."""
        horizon = F.timestamp_micros(F.unix_micros(now) - F.lit(micros(hours * 3600)))
        gone = [folder for found in self._before(spark, horizon).values() for folder in found]
        if gone:
            self.log.replace(spark, gone, None)


def telemetry_table(path: str) -> PointTable:
    """Raw readings: one value per machine, sensor, metric type and time."""
    return PointTable(path, ("machine_id", "sensor_id", "metric_type"), ("value",))


def metrics_table(path: str) -> PointTable:
    """Window statistics: five fields per sensor, machine and time."""
    return PointTable(
        path,
        ("sensor_id", "machine_id"),
        ("min_value", "mean_value", "max_value", "std_dev", "rate_of_change"),
    )
