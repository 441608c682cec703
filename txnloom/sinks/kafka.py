"""Messages to a Kafka topic. Needs the Spark Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..sources.kafka import with_options


def kafka_write_options(
    servers: str, topic: str, options: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Writer options for one topic, with any further ones of the connector."""
    return with_options({"kafka.bootstrap.servers": servers, "topic": topic}, options)


def publish(
    messages: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Send a finite frame of ``key, value`` messages."""
    chosen = kafka_write_options(servers, topic, options)
    messages.write.format("kafka").options(**chosen).save()
