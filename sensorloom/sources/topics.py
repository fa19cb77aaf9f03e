"""Topic sources and sinks: Kafka where the connector is present, files of the same shape otherwise.

Every frame has the Kafka source columns ``key, value, topic, partition, offset, timestamp``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorloom.schemas import KAFKA_FRAME


def read_topics(
    spark: SparkSession,
    topics: Sequence[str],
    *,
    servers: str | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    streaming: bool = True,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """One frame over several topics, from Kafka (``servers``) or from files (``path``).

    ``max_per_trigger`` bounds a micro-batch: records for Kafka, files for a file source.
    """
    reader = spark.readStream if streaming else spark.read
    if servers:
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .options(**{"startingOffsets": "earliest", **options})
        )
        if streaming and max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        frame = reader.load()
        return frame.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    if path is None:
        raise ValueError("read_topics needs servers= (Kafka) or path= (files)")
    reader = reader.schema(KAFKA_FRAME).options(**options)
    if streaming and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.format(file_format).load(path).where(F.col("topic").isin(*topics))


#: What a topic in files holds besides key and value; a broker gives these itself.
PLACE = ("partition", "offset", "timestamp")


def _placed(records: DataFrame, topic: str) -> DataFrame:
    """Records as a topic in files holds them. They carry their own partition, offset and time."""
    missing = [name for name in PLACE if name not in records.columns]
    if missing:
        raise ValueError(f"records of a topic in files need {', '.join(missing)}")
    named = records.withColumn("topic", F.lit(topic))
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KAFKA_FRAME])


def write_topic(
    records: DataFrame,
    topic: str,
    *,
    checkpoint: str,
    servers: str | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    **options: str,
) -> DataStreamWriter:
    """A stream writer for records with ``key`` and ``value``; records of one key stay together.

    Kafka hashes the key to a partition, which is what keeps each sensor's records in order. In files the
    records keep the partition, offset and time they carry, so readers see them in the order of their source.
    The file sink's own log makes whole batches visible, each once.
    """
    if servers:
        out = records.select("key", "value", F.lit(topic).alias("topic"))
        writer = out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    elif path is None:
        raise ValueError("write_topic needs servers= (Kafka) or path= (files)")
    else:
        writer = _placed(records, topic).writeStream.format(file_format).option("path", path)
    return writer.option("checkpointLocation", checkpoint).options(**options)


@dataclass(frozen=True)
class TopicSink:
    """A topic that ``foreachBatch`` bodies append to.

    In files a batch has the folder of its writer and id: a replay leaves a finished one alone and replaces a
    broken one. A broker gets a replayed batch again, as with any producer that isn't transactional.
    """

    topic: str
    path: str | None = None
    servers: str | None = None

    def write(self, records: DataFrame, batch_id: int, writer: str) -> None:
        if self.servers:
            out = records.select("key", "value", F.lit(self.topic).alias("topic"))
            out.write.format("kafka").option("kafka.bootstrap.servers", self.servers).save()
            return
        if self.path is None:
            raise ValueError("TopicSink needs servers= (Kafka) or path= (files)")
        folder = f"{self.path}/writer={writer}/batch_id={batch_id}"
        context = records.sparkSession.sparkContext
        done = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        if not done.getFileSystem(context._jsc.hadoopConfiguration()).exists(done):
            _placed(records, self.topic).write.mode("overwrite").parquet(folder)

    def read(self, spark: SparkSession) -> DataFrame:
        """All records of the topic so far."""
        if self.servers:
            return read_topics(spark, [self.topic], servers=self.servers, streaming=False)
        frame = read_topics(spark, [self.topic], path=self.path, streaming=False)
        return frame.select(*KAFKA_FRAME.names)
