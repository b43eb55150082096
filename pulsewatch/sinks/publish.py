"""Publishing rows as JSON messages (SNK5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.decode import encode_json
from ..functions.timefn import TEXT_TIMESTAMP_FORMAT
from ..sources import segments
from ..streaming.jobs import StreamSpec


def publish_kafka(df: DataFrame, topic: str, servers: str,
                  timestamp_format: str = TEXT_TIMESTAMP_FORMAT) -> None:
    """SNK5: PRJ12 -> one message per row on ``topic`` (needs the Kafka connector)."""
    (encode_json(df, timestamp_format=timestamp_format)
     .write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("topic", topic)
     .save())


def publish_text(df: DataFrame, path: str, timestamp_format: str = TEXT_TIMESTAMP_FORMAT,
                 mode: str = "append") -> None:
    """SNK5, file form: one JSON line per row under ``path`` (a text stream source)."""
    encode_json(df, timestamp_format=timestamp_format).write.mode(mode).text(path)


def publish_segments(df: DataFrame, path: str, timestamp_format: str = TEXT_TIMESTAMP_FORMAT) -> None:
    """SNK5 to a topic folder: one JSON message per row, published together as one segment."""
    segments.register(df.sparkSession)
    (encode_json(df, timestamp_format=timestamp_format).select("value")
     .write.format(segments.FORMAT).mode("append").save(path))


def segment_stream(messages: DataFrame, path: str, checkpoint: str, producer: str,
                   trigger: str | None = None) -> StreamSpec:
    """SNK5 as a stream: each micro-batch of ``value`` messages becomes one segment of the topic.

    ``producer`` names the publisher for good (together with its checkpoint): an epoch that is
    run again after a failure is recognised by it and not published twice.
    """
    segments.register(messages.sparkSession)
    return StreamSpec(producer, messages.select("value"), checkpoint, segments.FORMAT, trigger,
                      options={"path": path, "producer": producer})
