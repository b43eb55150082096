"""Message streams (SRC1).

The reference subscribes to a Kafka topic and keeps only the message value.
The file form reads new text files of a folder as they appear; it yields the
same single ``value`` column and is what runs here (no Kafka connector jar is
on this machine's classpath, so the Kafka form is built but untested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Reader options of a topic subscription (reference defaults)."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def subscribe(
    spark: SparkSession,
    topic: str,
    servers: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **extra: str,
) -> DataFrame:
    """SRC1 + PRJ1: a topic as a stream of ``value: string`` (key, offsets dropped)."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(servers, topic, starting_offsets, fail_on_data_loss, **extra))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC1, file form: every line of new files under ``path`` as ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
