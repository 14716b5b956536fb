"""Message transport of envelopes: a topic, or JSON lines landed in a folder.

The topic transport needs Spark's Kafka connector on the classpath; the folder
transport has the same shape and needs nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(
    servers: str, topic: str, starting: str = "earliest", truststore: str | None = None, **extra: str
) -> dict[str, str]:
    """Reader options: one topic, from the earliest offset, TLS when a truststore
    is given. Progress lives in the query's checkpoint, never in a consumer group."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if truststore:
        options["kafka.security.protocol"] = "SSL"
        options["kafka.ssl.truststore.location"] = truststore
    return {**options, **extra}


def read_messages(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """Stream with a text column ``value`` and the message's place: partition and
    offset of a ``topic``, or the landed file of a ``folder``."""
    if kind == "topic":
        stream = spark.readStream.format("kafka").options(**topic_options(**options)).load()
        return stream.select(
            F.col("value").cast("string").alias("value"),
            F.col("partition").alias("msg_partition"),
            F.col("offset").alias("msg_offset"),
        )
    if kind == "folder":
        path = options.pop("path")
        landed = spark.readStream.options(**options).text(path)
        return landed.select("value", F.col("_metadata.file_name").alias("msg_file"))
    raise ValueError(f"unknown message transport {kind!r}")


def message_sender(kind: str, **options: str) -> Callable[[DataFrame, int], None]:
    """Sends a batch's text column ``value``, without a key. A folder gets one part per
    batch, which a second try replaces; a topic may get a batch twice."""
    if kind == "folder":
        path = options.pop("path")

        def land(messages: DataFrame, batch_id: int) -> None:
            writer = messages.select("value").write.mode("overwrite").options(**options)
            writer.text(f"{path}/batch_id={batch_id}")

        return land
    if kind == "topic":
        servers, topic = options.pop("servers"), options.pop("topic")

        def send(messages: DataFrame, batch_id: int) -> None:
            writer = messages.select("value").write.format("kafka").options(**options)
            writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

        return send
    raise ValueError(f"unknown message transport {kind!r}")
