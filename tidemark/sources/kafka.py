"""Kafka source and sink.

The connector is a separate package (``org.apache.spark:spark-sql-kafka-0-10_2.13``) that the
cluster supplies with ``--packages``. Everything behind these functions only needs a ``value``
column, so the same jobs run on files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.events import encode_events


def _options(servers: str, topic: str, starting: str, fail_on_data_loss: bool) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """One topic as a stream.

    ``max_offsets`` bounds a micro-batch when the job catches up; ``min_partitions`` splits a topic
    partition that holds most of the backlog over several tasks.
    """
    reader = spark.readStream.format("kafka").options(**_options(servers, topic, starting, fail_on_data_loss))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def kafka_range(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str = "latest"
) -> DataFrame:
    """What a topic holds now, as a batch table."""
    return (
        spark.read.format("kafka")
        .options(**_options(servers, topic, starting, False), endingOffsets=ending)
        .load()
    )


def publish(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Write events to a topic as JSON, from a table or from a stream.

    Messages carry no key: the producer spreads them over all topic partitions, whatever item or
    user dominates.
    """
    values = encode_events(df)
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not values.isStreaming:
        values.write.format("kafka").options(**options).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream into a topic needs a checkpoint")
    return values.writeStream.format("kafka").options(**options, checkpointLocation=checkpoint).start()
