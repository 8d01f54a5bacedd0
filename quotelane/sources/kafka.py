"""Topic sources and sinks. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from quotelane import schemas
from quotelane.operators import codec

# The topics used unless others are named.
PRICES = "price"
ACCOUNT_POSITIONS = "positionsByAct"
SYMBOL_POSITIONS = "positionsBySymbol"
ACCOUNT_VALUES = "mvByAct"
SYMBOL_VALUES = "mvBySymbol"


def source_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_per_batch: int | None = None,
    max_records_per_partition: int | None = None,
    partition: int | None = None,
) -> dict[str, str]:
    """Options of a topic scan. ``starting`` counts for a new query; then its checkpoint does.

    ``max_records_per_partition`` cuts large topic partitions into several tasks. ``partition`` reads one
    partition only.
    """
    if not servers:
        raise ValueError("the address of the brokers is required")
    options = {
        "kafka.bootstrap.servers": servers,
        **({"subscribe": topic} if partition is None else {"assign": json.dumps({topic: [partition]})}),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if max_records_per_partition:
        options["maxRecordsPerPartition"] = str(max_records_per_partition)
    return options


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Message frame of a topic."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load()


def partition_streams(spark: SparkSession, servers: str, topic: str, partitions: int, **options) -> list[DataFrame]:
    """A message frame per partition of a topic, each read once."""
    return [topic_stream(spark, servers, topic, partition=p, **options) for p in range(partitions)]


def record_stream(spark: SparkSession, servers: str, topic: str, schema: str, **options) -> DataFrame:
    """Decoded records of a topic; the schema is a parameter."""
    return codec.decode(topic_stream(spark, servers, topic, **options), schema)


def price_stream(spark: SparkSession, servers: str, topic: str = PRICES, **options) -> DataFrame:
    return record_stream(spark, servers, topic, schemas.PRICE, **options)


def position_stream(spark: SparkSession, servers: str, topic: str = ACCOUNT_POSITIONS, **options) -> DataFrame:
    return record_stream(spark, servers, topic, schemas.POSITION, **options)


def symbol_position_stream(
    spark: SparkSession, servers: str, topic: str = SYMBOL_POSITIONS, **options
) -> DataFrame:
    return record_stream(spark, servers, topic, schemas.SYMBOL_POSITION, **options)


def sink_options(servers: str) -> dict[str, str]:
    if not servers:
        raise ValueError("the address of the brokers is required")
    return {"kafka.bootstrap.servers": servers}


def topic_writer(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Writer of an encoded frame (key, value, topic); delivery is at least once."""
    return (
        messages.writeStream.format("kafka")
        .options(**sink_options(servers))
        .option("checkpointLocation", checkpoint)
    )
