"""Kafka topics as a streaming source. Needs the Spark Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_read_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one topic.

    ``starting`` applies only to a checkpoint's first run. ``min_partitions``
    splits a topic's partitions into more tasks, which matters when a constant
    message key has put all records into one of them. ``max_offsets_per_trigger``
    bounds a micro-batch. ``options`` are any further ones of the connector, such as
    ``kafka.security.protocol`` for a secured broker; they may not contradict the others.
    """
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if min_partitions is not None:
        chosen["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return with_options(chosen, options)


def with_options(chosen: dict[str, str], options: Mapping[str, str] | None) -> dict[str, str]:
    """Both together; an option given in two ways is refused."""
    twice = {name.lower() for name in chosen} & {name.lower() for name in options or ()}
    if twice:
        raise ValueError(f"options given twice: {sorted(twice)}")
    return {**chosen, **(options or {})}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **limits) -> DataFrame:
    """The topic as an unbounded frame in Kafka's fixed schema; payload in ``value``."""
    options = kafka_read_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load()
