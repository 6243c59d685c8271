"""Kafka source and sink options.

Broker address and credentials are parameters (or read from environment
variables chosen by the caller); none is stored in the repository. The Kafka
connector jar must be on the classpath (``spark.jars.packages`` at submit
time); nothing here starts without it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: str
    security_protocol: str | None = None  # e.g. "SASL_PLAINTEXT"
    sasl_mechanism: str | None = None  # e.g. "PLAIN"
    username: str | None = None
    password: str | None = field(default=None, repr=False)

    @classmethod
    def from_env(cls, prefix: str = "SENSORWATCH_KAFKA_") -> "KafkaSettings":
        """Read ``<prefix>BOOTSTRAP_SERVERS``, ``SECURITY_PROTOCOL``, ``SASL_MECHANISM``, ``USERNAME``, ``PASSWORD``."""
        env = os.environ
        servers = env.get(prefix + "BOOTSTRAP_SERVERS")
        if not servers:
            raise KeyError(f"{prefix}BOOTSTRAP_SERVERS is not set")
        return cls(
            bootstrap_servers=servers,
            security_protocol=env.get(prefix + "SECURITY_PROTOCOL"),
            sasl_mechanism=env.get(prefix + "SASL_MECHANISM"),
            username=env.get(prefix + "USERNAME"),
            password=env.get(prefix + "PASSWORD"),
        )

    def options(self) -> dict[str, str]:
        """``kafka.*`` options shared by the source and the sink."""
        opts = {"kafka.bootstrap.servers": self.bootstrap_servers}
        if self.security_protocol:
            opts["kafka.security.protocol"] = self.security_protocol
        if self.sasl_mechanism:
            opts["kafka.sasl.mechanism"] = self.sasl_mechanism
        if self.username is not None:
            user, pwd = ((x or "").replace("\\", "\\\\").replace('"', '\\"') for x in (self.username, self.password))
            opts["kafka.sasl.jaas.config"] = f'{_PLAIN_LOGIN} required username="{user}" password="{pwd}";'
        return opts


def source_options(
    kafka: KafkaSettings,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka stream source.

    ``min_partitions`` splits the offset range of each micro-batch over at
    least that many tasks; without it a topic with few partitions (two, say)
    is read by as few tasks however large the cluster.
    """
    opts = dict(kafka.options())
    opts["subscribe"] = topic
    opts["startingOffsets"] = starting_offsets
    opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_kafka_stream(spark: SparkSession, kafka: KafkaSettings, topic: str, **kwargs) -> DataFrame:
    """Streaming DataFrame of raw Kafka records (``key, value, topic, partition, offset, timestamp, …``).

    Feed it to :func:`sensorwatch.functions.decode.decode_readings`. Spark reads
    each Kafka partition in its own task, so parallelism follows the topic's
    partition count unless ``min_partitions`` splits further.
    """
    return spark.readStream.format("kafka").options(**source_options(kafka, topic, **kwargs)).load()
