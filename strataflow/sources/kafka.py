"""Topic source. Needs the Kafka connector package; login options are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str, topic: str, pattern: bool = False, **options: str
) -> dict[str, str]:
    """Reader options for one topic, or for all topics matching a regular expression.

    Reads from the earliest offset unless overridden. Records that expired unread fail the stream;
    pass ``failOnDataLoss="false"`` to go on without them. Pass ``minPartitions`` or ``maxRecordsPerPartition`` to split a busy topic partition over several
    tasks, and ``maxOffsetsPerTrigger`` to bound a backlog's batches.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribePattern" if pattern else "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }


def read_kafka(
    spark: SparkSession, servers: str, topic: str, pattern: bool = False, **options: str
) -> DataFrame:
    """Stream of Kafka records: key, value, topic, partition, offset, timestamp."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, pattern, **options)).load()
