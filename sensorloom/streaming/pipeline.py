"""The whole service as chained streaming queries, each with a checkpoint of its own, joined by topics.

raw topics -> ingest -> cleaned topic -> raw points
                                     \\-> analyzer (with the lifecycle channel) -> processed topic
                                            -> decision -> signals topic
                                            \\-> window points

Every query commits by itself, and what lies between two of them is a topic: one that is stopped goes on from
its checkpoint, and those before and behind it never notice. ``start`` runs all at once; ``drain`` runs each over
what there is, in the order of the chain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sensorloom.constants import TOPIC_CLEANED, TOPIC_PRESSURE, TOPIC_PROCESSED, TOPIC_SIGNALS, TOPIC_TEMPERATURE
from sensorloom.operators.windows import WindowSpec
from sensorloom.sources.points import PointTable, metrics_table, telemetry_table
from sensorloom.sources.topics import TopicSink, read_topics, write_topic
from sensorloom.streaming import jobs


@dataclass(frozen=True)
class Pipeline:
    """All stages below ``root``, a folder that the driver and all executors reach.

    ``raw`` gives the raw topics and ``lifecycle`` the parsed lifecycle events as streams; ``config`` is read anew
    for each batch of decisions. ``now`` is the clock; ``emitted_at`` stamps windows. ``generation`` names the
    checkpoints: a pipeline that starts over takes a new one, so that its batches don't replace earlier ones.
    """

    spark: SparkSession
    root: str
    raw: Callable[[], DataFrame]
    lifecycle: Callable[[], DataFrame]
    config: Callable[[], DataFrame]
    now: Column
    emitted_at: Column
    spec: WindowSpec = field(default_factory=WindowSpec)
    generation: str = "1"
    #: Files of a topic that a micro-batch takes at most, so that a backlog is worked off in bounded steps.
    max_files: int = 256

    def topic_path(self, topic: str) -> str:
        return f"{self.root}/topics/{topic}"

    @property
    def telemetry(self) -> PointTable:
        return telemetry_table(f"{self.root}/telemetry")

    @property
    def metrics(self) -> PointTable:
        return metrics_table(f"{self.root}/metrics")

    @property
    def alarms(self) -> TopicSink:
        return TopicSink(TOPIC_SIGNALS, self.topic_path(TOPIC_SIGNALS))

    @property
    def health(self) -> jobs.StageHealth:
        return jobs.StageHealth(self._folder("decision-lags"), self._folder("decision-latencies"))

    def rejects(self, stage: str) -> jobs.OutputFolder:
        """What a stage (``ingest`` or ``decision``) has given up, with the reason."""
        return self._folder(f"{stage}-rejects")

    def _folder(self, name: str) -> jobs.OutputFolder:
        return jobs.OutputFolder(f"{self.root}/{name}")

    def _checkpoint(self, stage: str) -> str:
        return f"{self.root}/checkpoints/{stage}-{self.generation}"

    def _reads(self, topic: str) -> DataFrame:
        return read_topics(self.spark, [topic], path=self.topic_path(topic), max_per_trigger=self.max_files)

    def _each(self, topic: str, stage: str, body: jobs.BatchBody) -> DataStreamWriter:
        return self._reads(topic).writeStream.foreachBatch(body).option("checkpointLocation", self._checkpoint(stage))

    def ingest(self) -> DataStreamWriter:
        body = jobs.ingest_body(
            TopicSink(TOPIC_CLEANED, self.topic_path(TOPIC_CLEANED)),
            self.rejects("ingest"),
            self._folder("ingest-counters"),
            self._writer("ingest"),
        )
        return self.raw().writeStream.foreachBatch(body).option("checkpointLocation", self._checkpoint("ingest"))

    def raw_points(self) -> DataStreamWriter:
        return self._each(TOPIC_CLEANED, "telemetry", jobs.telemetry_sink(self.telemetry, self.now, self._writer("telemetry")))

    def analyzer(self) -> DataStreamWriter:
        records = jobs.processed_stream(
            self._reads(TOPIC_CLEANED), self.lifecycle(), self.now, self.emitted_at, self.spec
        )
        return write_topic(
            records, TOPIC_PROCESSED, checkpoint=self._checkpoint("analyzer"), path=self.topic_path(TOPIC_PROCESSED)
        )

    def decision(self) -> DataStreamWriter:
        body = jobs.decision_body(
            self.config,
            self.alarms,
            self._folder("decision-counters"),
            self.now,
            self._writer("decision"),
            health=self.health,
            rejects=self.rejects("decision"),
        )
        return self._each(TOPIC_PROCESSED, "decision", body)

    def window_points(self) -> DataStreamWriter:
        body = jobs.metrics_sink(self.metrics, self._folder("sink-counters"), self.now, self._writer("metrics"))
        return self._each(TOPIC_PROCESSED, "metrics", body)

    def _writer(self, stage: str) -> str:
        return f"{stage}-{self.generation}"

    def stages(self) -> dict[str, Callable[[], DataStreamWriter]]:
        """Every stage, in the order of the chain."""
        return {
            "ingest": self.ingest,
            "raw_points": self.raw_points,
            "analyzer": self.analyzer,
            "decision": self.decision,
            "window_points": self.window_points,
        }

    def start(self, interval: str = "1 second") -> dict[str, StreamingQuery]:
        """All stages at once, each with a micro-batch per ``interval``."""
        return {
            name: stage().queryName(f"{name}-{self.generation}").trigger(processingTime=interval).start()
            for name, stage in self.stages().items()
        }

    def drain(self) -> None:
        """One stage after the other over what its topic holds by then."""
        for stage in self.stages().values():
            stage().trigger(availableNow=True).start().awaitTermination()
