"""A topic as a folder of segments: source with own offsets, sink with epochs (SRC1, SNK5).

A text file stream remembers every file it has seen and can only start at the
beginning. This data source has offsets, as a message log has: a topic is a folder of

* ``data/<name>``: message files, one message a line, written by tasks;
* ``segments/<number>.json``: one manifest per published write, naming its files, its producer
  and its epoch. Manifests are numbered without gaps and created exclusively, so a segment
  appears whole or not at all, and two producers cannot take one number.

A **stream** (``readStream.format("segments")``) reads whole segments. Its offset is the number
of the next segment. ``startingOffsets`` is ``latest`` (default, as the reference's
jobs) or ``earliest``; the first offset is kept in the file ``startFile`` names (put it next to the
checkpoint), so that a query that dies before its first commit starts again where it was.
``failOnDataLoss`` (default false, as the reference's) decides what happens where a segment of the
range, or one of its files, is gone: the query fails, or goes on without it and notes the
loss in ``lossPath``, one small file per lost segment.

**Publishing** (``write`` or ``writeStream.format("segments")``): tasks write files, the commit
message of each carries its file name and row count, and the driver publishes them as one segment. A stream's
segment carries its ``producer`` and epoch; an epoch that is replayed after a failure finds its manifest and is
not published twice.

Spark has no available-now trigger for sources in Python; use ``streaming.jobs.run_caught_up`` for a run that ends.

The folder must be one that driver and executors mount under the same path (as the
shared folder of ``spark.checkpoint.dir``); it needs exclusive file creation, which object stores do not
offer through a file path. No message is ever held on the driver: it sees names and counts.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter,
    InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "segments"
SCHEMA = "value string, segment bigint"
BATCH_LINES = 8192
_MANIFEST = re.compile(r"^(\d{20})\.json$")


class DataLossError(RuntimeError):
    """A segment of the requested range is gone and ``failOnDataLoss`` is set."""


# --- the topic's folder ------------------------------------------------------------------

def _local(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"a topic needs a mounted folder, not {path!r}")
    return (parsed.path if parsed.scheme else path).rstrip("/")


class Topic:
    """The segments of one topic folder."""

    def __init__(self, path: str):
        self.path = _local(path)

    def _file(self, number: int) -> str:
        return f"{self.path}/segments/{number:020d}.json"

    def numbers(self) -> list[int]:
        """Numbers of the segments on file, ascending."""
        try:
            names = os.listdir(f"{self.path}/segments")
        except FileNotFoundError:
            return []
        return sorted(int(m[1]) for m in map(_MANIFEST.match, names) if m)

    def end(self) -> int:
        """The number that the next segment will get."""
        numbers = self.numbers()
        return numbers[-1] + 1 if numbers else 0

    def manifest(self, number: int) -> dict | None:
        """The manifest of a segment; None if it is gone."""
        try:
            with open(self._file(number), encoding="utf-8") as f:
                return json.load(f)
        except FileNotFoundError:
            return None

    def data(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def published(self, producer: str, epoch: int) -> int | None:
        """The segment that an epoch of a producer was published as.

        Looks from the newest back and stops at an earlier epoch of the same producer.
        """
        for number in reversed(self.numbers()):
            manifest = self.manifest(number)
            if manifest and manifest["producer"] == producer and manifest["epoch"] <= epoch:
                return number if manifest["epoch"] == epoch else None
        return None

    def publish(self, files: list[str], rows: int, producer: str, epoch: int) -> int:
        """Make a segment of written files; the number it got."""
        os.makedirs(f"{self.path}/segments", exist_ok=True)
        text = json.dumps({"files": sorted(files), "rows": rows, "producer": producer, "epoch": epoch})
        ready = f"{self.path}/segments/.{uuid.uuid4().hex}"
        with open(ready, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            number = self.end()
            while True:
                try:
                    os.link(ready, self._file(number))  # fails if another producer took the number
                    return number
                except FileExistsError:
                    number += 1
        finally:
            os.unlink(ready)

    def drop(self, number: int) -> None:
        """Delete a segment and its files, as a retention run would."""
        manifest = self.manifest(number)
        if manifest is None:
            return
        os.unlink(self._file(number))
        for name in manifest["files"]:
            if os.path.exists(self.data(name)):
                os.unlink(self.data(name))


# --- reading ---------------------------------------------------------------------------

def _options(given: dict[str, str]) -> dict[str, str]:
    """Option names in lower case: Spark does not tell cases apart."""
    return {k.lower(): v for k, v in given.items()}


@dataclass
class SegmentFile(InputPartition):
    """One message file of a segment; ``name`` is None for a segment whose manifest is gone."""

    segment: int
    name: str | None


class _Reading:
    """What batch and stream readers share: planning files and reading them."""

    def __init__(self, options: dict):
        self.topic = Topic(options["path"])
        self.strict = options.get("failondataloss", "false").lower() == "true"
        self.loss_path = options.get("losspath")

    def files(self, start: int, end: int) -> list[SegmentFile]:
        out = []
        for number in range(start, end):
            manifest = self.topic.manifest(number)
            if manifest is None:
                out.append(SegmentFile(number, None))
            else:
                out += [SegmentFile(number, name) for name in manifest["files"]]
        return out

    def _lost(self, part: SegmentFile) -> None:
        if self.strict:
            raise DataLossError(f"segment {part.segment} of {self.topic.path} is gone")
        if self.loss_path:
            folder = _local(self.loss_path)
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{part.segment:020d}", "a", encoding="utf-8"):
                pass

    def lines(self, part: SegmentFile | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # a topic without segments
            return
        if part.name is None:
            self._lost(part)
            return
        try:
            file = open(self.topic.data(part.name), encoding="utf-8", newline="\n")
        except FileNotFoundError:
            self._lost(part)
            return
        with file:
            batch: list[str] = []
            for line in file:
                batch.append(line.removesuffix("\n"))
                if len(batch) == BATCH_LINES:
                    yield _rows(batch, part.segment)
                    batch = []
            if batch:
                yield _rows(batch, part.segment)


def _rows(lines: list[str], segment: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([segment] * len(lines), pa.int64())],
                                      names=["value", "segment"])


class SegmentReader(DataSourceReader):
    """Every segment on file, in one batch."""

    def __init__(self, options: dict):
        self.reading = _Reading(options)

    def partitions(self) -> list[SegmentFile]:
        numbers = self.reading.topic.numbers()
        return self.reading.files(numbers[0], numbers[-1] + 1) if numbers else []

    def read(self, partition: SegmentFile) -> Iterator[pa.RecordBatch]:
        return self.reading.lines(partition)


class SegmentStream(DataSourceStreamReader):
    """Whole segments from a starting offset on."""

    def __init__(self, options: dict):
        self.reading = _Reading(options)
        self.starting = options.get("startingoffsets", "latest").lower()
        if self.starting not in ("latest", "earliest"):
            raise ValueError(f"startingOffsets must be latest or earliest, not {self.starting!r}")
        self.start_file = options.get("startfile")

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's interface
        topic = self.reading.topic
        numbers = topic.numbers()
        first = topic.end() if self.starting == "latest" else numbers[0] if numbers else 0
        if not self.start_file:
            return {"segment": first}
        path = _local(self.start_file)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        ready = f"{path}.{uuid.uuid4().hex}"
        with open(ready, "w", encoding="utf-8") as f:
            json.dump({"segment": first}, f)
        try:
            os.link(ready, path)
        except FileExistsError:  # this query has started before
            with open(path, encoding="utf-8") as f:
                return json.load(f)
        finally:
            os.unlink(ready)
        return {"segment": first}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"segment": self.reading.topic.end()}

    def partitions(self, start: dict, end: dict) -> list[SegmentFile]:
        return self.reading.files(start["segment"], end["segment"])

    def read(self, partition: SegmentFile) -> Iterator[pa.RecordBatch]:
        return self.reading.lines(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: segments belong to the topic, not to one of its readers."""


# --- writing ----------------------------------------------------------------------------

@dataclass
class WrittenFile(WriterCommitMessage):
    """What one task wrote: a file name (None if it had no rows) and its rows."""

    name: str | None
    rows: int


class _Writing:
    def __init__(self, options: dict):
        self.topic = Topic(options["path"])
        self.producer = options.get("producer") or uuid.uuid4().hex

    def write_lines(self, rows: Iterator) -> WrittenFile:
        os.makedirs(f"{self.topic.path}/data", exist_ok=True)
        name, count = f"{uuid.uuid4().hex}.txt", 0
        with open(self.topic.data(name), "w", encoding="utf-8", newline="\n") as f:
            for batch in rows:
                values = batch.column(0).to_pylist()
                if any(v is None or "\n" in v for v in values):
                    raise ValueError("a message must be a text without line feeds")
                count += len(values)
                f.writelines(f"{v}\n" for v in values)
        if not count:
            os.unlink(self.topic.data(name))
        return WrittenFile(name if count else None, count)

    def discard(self, messages: list[WrittenFile | None]) -> None:
        for m in messages:
            if m is not None and m.name and os.path.exists(self.topic.data(m.name)):
                os.unlink(self.topic.data(m.name))

    def publish(self, messages: list[WrittenFile | None], epoch: int) -> None:
        done = [m for m in messages if m is not None]
        if self.topic.published(self.producer, epoch) is not None:
            self.discard(done)  # a replayed epoch: its segment is out already
            return
        files = [m.name for m in done if m.name]
        if files:
            self.topic.publish(files, sum(m.rows for m in done), self.producer, epoch)


class SegmentWriter(DataSourceWriter):
    """A batch write: one segment."""

    def __init__(self, options: dict):
        self.writing = _Writing(options)

    def write(self, iterator: Iterator) -> WrittenFile:
        return self.writing.write_lines(_batches(iterator))

    def commit(self, messages: list[WrittenFile | None]) -> None:
        self.writing.publish(messages, 0)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        self.writing.discard(messages)


class SegmentStreamWriter(DataSourceStreamWriter):
    """A streaming write: one segment per epoch, published once."""

    def __init__(self, options: dict):
        if not options.get("producer"):
            raise ValueError("a streaming producer needs a name that survives restarts: set the option 'producer'")
        self.writing = _Writing(options)

    def write(self, iterator: Iterator) -> WrittenFile:
        return self.writing.write_lines(_batches(iterator))

    def commit(self, messages: list[WrittenFile | None], batchId: int) -> None:  # noqa: N803
        self.writing.publish(messages, batchId)

    def abort(self, messages: list[WrittenFile | None], batchId: int) -> None:  # noqa: N803
        self.writing.discard(messages)


def _batches(rows: Iterator) -> Iterator[pa.RecordBatch]:
    """Rows of one text column as record batches of bounded size."""
    batch: list[str | None] = []
    for row in rows:
        batch.append(row[0])
        if len(batch) == BATCH_LINES:
            yield pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["value"])
            batch = []
    if batch:
        yield pa.RecordBatch.from_arrays([pa.array(batch, pa.string())], names=["value"])


class SegmentSource(DataSource):
    """``format("segments")``; see the module's text for the options."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(_options(self.options))

    def streamReader(self, schema: StructType) -> SegmentStream:  # noqa: N802
        return SegmentStream(_options(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> SegmentWriter:
        if overwrite:
            raise ValueError("a topic is appended to; use mode('append')")
        return SegmentWriter(_options(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> SegmentStreamWriter:  # noqa: N802
        return SegmentStreamWriter(_options(self.options))


# --- Spark -------------------------------------------------------------------------------

def register(spark: SparkSession) -> None:
    spark.dataSource.register(SegmentSource)


def subscribe_segments(spark: SparkSession, path: str, starting_offsets: str = "latest",
                       fail_on_data_loss: bool = False, start_file: str | None = None,
                       loss_path: str | None = None) -> DataFrame:
    """SRC1 + PRJ1: a topic folder as a stream of ``value: string`` (offsets dropped)."""
    register(spark)
    reader = (spark.readStream.format(FORMAT).option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if start_file:
        reader = reader.option("startFile", start_file)
    if loss_path:
        reader = reader.option("lossPath", loss_path)
    return reader.load(path).select(F.col("value").cast("string").alias("value"))


def read_segments(spark: SparkSession, path: str, fail_on_data_loss: bool = False) -> DataFrame:
    """Every message on file with its segment number."""
    register(spark)
    return spark.read.format(FORMAT).option("failOnDataLoss", str(fail_on_data_loss).lower()).load(path)


def lost_segments(spark: SparkSession, loss_path: str) -> DataFrame:
    """``segment``: the numbers that readers with this ``lossPath`` went on without."""
    folder = _local(loss_path)
    names = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    return spark.createDataFrame([(int(n),) for n in names], "segment bigint")
