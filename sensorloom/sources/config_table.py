"""The stored sensor configuration: a base and deltas under a commit log, merged by key.

Registrations arrive in batches; each adds a delta and becomes visible as a whole. A snapshot merges the base with
the deltas, the last request of a sensor winning, and stays what it is while later batches come. When deltas pile up
they are merged into a new base, in one commit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from sensorloom.operators import registry
from sensorloom.sources.commits import CommitLog

ORDER = "request_no"
SCHEMA = T.StructType(
    [
        T.StructField(ORDER, T.LongType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        *[
            T.StructField(name, T.DoubleType())
            for name in ("base_mean", "variance", "min_threshold", "max_threshold", "max_std_dev", "max_drift")
        ],
        T.StructField("interval_ns", T.LongType()),
    ]
)


@dataclass(frozen=True)
class ConfigTable:
    """The configuration below ``path``; more than ``deltas`` deltas are merged into the base."""

    path: str
    deltas: int = 16

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path)

    def register(self, requests: DataFrame, batch_id: int, writer: str) -> None:
        """Normalise a batch of requests, reject unknown types, and make the rest visible at once."""

        def write(folder: str) -> dict:
            rows = registry.register(requests)
            rows.select(*[f.name for f in SCHEMA]).write.parquet(folder)
            return {"": {"kind": "delta"}}

        spark = requests.sparkSession
        now = self.log.append(spark, writer, batch_id, write)
        if sum(held["kind"] == "delta" for held in now.folders.values()) > self.deltas:
            self.merge(spark)

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """The configuration of every sensor as of now."""
        return self._of(spark, list(self.log.snapshot(spark).folders))

    def _of(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], SCHEMA)
        return registry.upsert(spark.read.schema(SCHEMA).parquet(*self.log.paths(folders)), ORDER)

    def merge(self, spark: SparkSession) -> None:
        """Base and deltas into a new base."""
        folders = list(self.log.snapshot(spark).folders)

        def write(folder: str) -> dict:
            self._of(spark, folders).write.parquet(folder)
            return {"": {"kind": "base"}}

        self.log.replace(spark, folders, write)
