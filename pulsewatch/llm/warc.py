"""WARC archives as a Spark data source (``format("warc")``), reading and writing.

Writing: each task appends records, one gzip member a record, to files of its
own that are rolled at ``file_bytes``; the job's commit lists the files of successful
tasks in a manifest, and only listed files are read, so a task that ran twice
leaves nothing behind in a result.

Reading: files are planned into partitions of about ``split_bytes``; a file is
read by one task, front to back. Filters on header columns are pushed to the
reader, which unpacks a record's header first and decides there. A member
written here carries its length in the gzip ``sl`` extra field, so an unwanted
payload is passed over without being unpacked; in files without it (or with
plain ``.warc``) it is unpacked and dropped, or skipped by its length.
``payload=false`` reads headers only.

Paths go through ``pyarrow.fs``, so a folder is local, or any store that
pyarrow opens, and must be one that all executors reach.

Damaged archives: a record that is cut off, starts with no WARC line or gzip member, or has a malformed
Content-Length is never returned. With ``damaged=error`` (the default) it ends the read with the
file's name and the record's place; with ``damaged=stop`` the file is read up to that record and the next file
follows.

Cases: null payload is empty; null header values are left out and read as
null; a header that occurs several times is one entry of ``fields`` with the values on lines of their own, and
is written that way; other control characters in header values are percent-encoded; an empty folder
or table gives no records; payloads of any length are one record each.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
    StringStartsWith, WriterCommitMessage)

HEADERS = ("warc_type string, record_id string, target_uri string, warc_date string, refers_to string, "
           "payload_digest string, content_type string, content_length long, fields map<string,string>")
SCHEMA = f"{HEADERS}, payload binary, file string, offset long"
# Header names of the columns.
NAMES = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
         "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
         "content_type": "Content-Type", "content_length": "Content-Length"}
HTTP = "application/http; msgtype=response"
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
UNKNOWN = 0xFFFFFFFF


class DamagedArchive(ValueError):
    """A record that cannot be read whole."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _split(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


# --- records --------------------------------------------------------------------

def member(record: bytes, level: int = 6) -> bytes:
    """One gzip member whose extra field tells its packed and unpacked lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    lengths = (total, len(record)) if max(total, len(record)) < UNKNOWN else (UNKNOWN, UNKNOWN)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, *lengths)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """A record: headers, then the payload as the body of an HTTP response."""
    payload = row.get("payload") or b""
    block = payload
    if (row.get("content_type") or HTTP) == HTTP:
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    head = {"WARC-Type": row.get("warc_type") or "resource",
            "WARC-Record-ID": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Target-URI": row.get("target_uri"), "WARC-Date": row.get("warc_date") or "1970-01-01T00:00:00Z",
            "WARC-Refers-To": row.get("refers_to"), "WARC-Payload-Digest": row.get("payload_digest"),
            "Content-Type": row.get("content_type") or HTTP}
    pairs = [(k, v) for k, v in head.items() if v is not None]
    pairs += [(k, line) for k, v in dict(row.get("fields") or {}).items() if v is not None for line in v.split("\n")]
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in [*pairs, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict:
    """Header columns of a record's leading lines."""
    pairs: list[list[str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and pairs:  # a folded line
            pairs[-1][1] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            pairs.append([name.strip(), value.strip()])
    row: dict = dict.fromkeys(NAMES)
    columns = {n.lower(): c for c, n in NAMES.items()}
    fields: dict[str, tuple[str, list[str]]] = {}
    for name, value in pairs:
        column = columns.get(name.lower())
        if column and row[column] is None:
            row[column] = value
        else:
            fields.setdefault(name.lower(), (name, []))[1].append(value)
    length = row["content_length"] or "0"
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        raise DamagedArchive(f"Content-Length {length[:40]!r}")
    row["content_length"] = int(length)
    row["fields"] = [(name, "\n".join(values)) for name, values in fields.values()]
    return row


def payload_of(block: bytes, content_type: str | None) -> bytes:
    """The block without HTTP headers, if it is an HTTP message."""
    if (content_type or "").startswith("application/http"):
        _, found, body = block.partition(b"\r\n\r\n")
        return body if found else b""
    return block


class Window:
    """A file read front to back through one buffer; can pass over bytes."""

    CHUNK = 1 << 20

    def __init__(self, file):  # noqa: ANN001 - a pyarrow file
        self.file, self.buffer, self.at, self.base = file, b"", 0, 0
        self.size = file.size()

    @property
    def offset(self) -> int:
        return self.base + self.at

    def fill(self, n: int) -> int:
        """Try to have ``n`` bytes ahead; returns how many there are."""
        while len(self.buffer) - self.at < n and self.base + len(self.buffer) < self.size:
            more = self.file.read_at(max(self.CHUNK, n), self.base + len(self.buffer))
            if not more:
                break
            self.base += self.at
            self.buffer = self.buffer[self.at:] + more
            self.at = 0
        return len(self.buffer) - self.at

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = self.buffer[self.at:self.at + n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        if self.at + n <= len(self.buffer):
            self.at += n
        else:
            self.base, self.buffer, self.at = self.offset + n, b"", 0


def _gzip_head(window: Window) -> tuple[int, int | None]:
    """(length of the gzip header, whole member's length if it tells)."""
    if window.fill(12) < 10 or window.buffer[window.at:window.at + 3] != b"\x1f\x8b\x08":
        raise DamagedArchive(f"no gzip member at {window.offset}")
    flags, at, total = window.buffer[window.at + 3], 10, None
    if flags & 4:
        extra = struct.unpack_from("<H", window.buffer, window.at + 10)[0]
        window.fill(12 + extra)
        fields, i = window.buffer[window.at + 12:window.at + 12 + extra], 0
        while i + 4 <= len(fields):
            size = struct.unpack_from("<H", fields, i + 2)[0]
            if fields[i:i + 2] == b"sl" and size == 8:
                total = struct.unpack_from("<I", fields, i + 4)[0]
                total = None if total == UNKNOWN else total
            i += 4 + size
        at += 2 + extra
    for bit in (8, 16):  # name, comment
        if flags & bit:
            while True:
                window.fill(at + 1)
                at += 1
                if window.buffer[window.at + at - 1] == 0:
                    break
    return at + (2 if flags & 2 else 0), total


def _head_at(head: bytes, offset: int) -> dict:
    if not head.startswith(b"WARC/"):
        raise DamagedArchive(f"no WARC record at {offset}")
    try:
        return parse_head(head)
    except DamagedArchive as e:
        raise DamagedArchive(f"record at {offset}: {e}") from None


def records(window: Window, wanted, payload: bool) -> Iterator[tuple[int, dict, bytes | None]]:  # noqa: ANN001
    """(offset, header columns, block or None) of the records that ``wanted`` accepts by header."""
    while window.fill(4):
        offset = window.offset
        if window.buffer[window.at:window.at + 2] == b"\x1f\x8b":
            head_size, total = _gzip_head(window)
            unpack = zlib.decompressobj(-15)
            start, fed, out = head_size, 0, b""
            rest = b""

            def feed(limit: int) -> bytes:
                """Unpack up to ``limit`` more bytes."""
                nonlocal fed, rest
                if not rest and not unpack.eof:
                    step = 1 << 12 if not fed else 1 << 16
                    window.fill(start + fed + step)
                    rest = window.buffer[window.at + start + fed:window.at + start + fed + step]
                    if not rest:
                        raise DamagedArchive(f"record at {offset} is cut off")
                    fed += len(rest)
                try:
                    got = unpack.decompress(rest, limit)
                except zlib.error as e:
                    raise DamagedArchive(f"record at {offset}: {e}") from None
                rest = unpack.unconsumed_tail
                return got

            while b"\r\n\r\n" not in out and not unpack.eof:
                out += feed(1 << 13)
            head, whole, block = out.partition(b"\r\n\r\n")
            if not whole:
                raise DamagedArchive(f"record at {offset} is cut off")
            row = _head_at(head, offset)
            keep = wanted(row)
            if keep and payload:
                parts = [block]
                while not unpack.eof:
                    parts.append(feed(1 << 20))
                block = b"".join(parts)[:row["content_length"]]
                if len(block) < row["content_length"]:
                    raise DamagedArchive(f"record at {offset} is cut off")
            if total is None:
                while not unpack.eof:
                    feed(1 << 20)
                total = start + fed - len(unpack.unused_data) + 8
            if offset + total > window.size:
                raise DamagedArchive(f"record at {offset} is cut off")
            window.skip(total)
            if keep:
                yield offset, row, block if payload else None
        else:
            size = 1 << 12
            while b"\r\n\r\n" not in window.buffer[window.at:window.at + size] and window.fill(size) >= size:
                size *= 2
            lead = window.buffer[window.at:window.at + size]
            blank = len(lead) - len(lead.lstrip(b"\r\n"))
            if blank == len(lead):
                return
            end = lead.find(b"\r\n\r\n", blank)
            if end < 0:
                raise DamagedArchive(f"record at {offset} is cut off")
            row = _head_at(lead[blank:end], offset + blank)
            window.skip(end + 4)
            if window.offset + row["content_length"] > window.size:
                raise DamagedArchive(f"record at {offset + blank} is cut off")
            keep = wanted(row)
            block = window.take(row["content_length"]) if keep and payload else window.skip(row["content_length"])
            window.skip(min(4, window.fill(4)))
            if keep:
                yield offset + blank, row, block


# --- data source --------------------------------------------------------------------

def _accepts(condition: Filter, row: dict) -> bool:
    if isinstance(condition, Not):
        value = row.get(condition.child.attribute[0])
        return value is not None and not _accepts(condition.child, row)
    value = row.get(condition.attribute[0])
    if isinstance(condition, IsNull):
        return value is None
    if value is None:
        return False
    tests = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
             LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b,
             StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}
    return isinstance(condition, IsNotNull) or tests[type(condition)](value, condition.value)


_TESTABLE = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, StringStartsWith,
             StringEndsWith, StringContains, IsNotNull, IsNull)


def _pushable(condition: Filter) -> bool:
    inner = condition.child if isinstance(condition, Not) else condition
    return isinstance(inner, _TESTABLE) and len(inner.attribute) == 1 and inner.attribute[0] in NAMES


@dataclass
class Files(InputPartition):
    names: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.split_bytes = int(options.get("split_bytes", 64 << 20))
        self.damaged = options.get("damaged", "error").lower()
        if self.damaged not in ("error", "stop"):
            raise ValueError(f"damaged must be error or stop, not {self.damaged!r}")
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 - Spark's name
        for condition in filters:
            if _pushable(condition):
                self.conditions.append(condition)
            else:
                yield condition

    def partitions(self) -> list[Files]:
        """Files by manifest, or all archives of the folder, in groups of about ``split_bytes``."""
        store, path = _split(self.path)
        found = store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        infos = {i.path: i for i in found if i.is_file}
        manifests = [p for p in infos if p.rsplit("/", 1)[-1].startswith("_manifest-")]
        names = [f"{path}/{n}" for m in manifests for n in json.loads(store.open_input_file(m).read())] if manifests \
            else [p for p in infos if p.endswith((".warc", ".warc.gz"))]
        groups, group, size = [], [], 0
        for name in sorted(names):
            if group and size + infos[name].size > self.split_bytes:
                groups.append(Files(group))
                group, size = [], 0
            group.append(name)
            size += infos[name].size
        return [*groups, Files(group)] if group else groups or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _split(self.path)
        schema = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                            ("warc_date", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
                            ("content_type", pa.string()), ("content_length", pa.int64()),
                            ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
                            ("file", pa.string()), ("offset", pa.int64())])
        rows, size = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                for offset, row, block in self._whole(name, file):
                    body = None if block is None else payload_of(block, row["content_type"])
                    digest = row["payload_digest"]
                    if self.verify and body is not None and row["warc_type"] != "revisit" and digest \
                            and digest.split(":")[-1] != base32_sha1(body):
                        raise ValueError(f"{name}: payload at {offset} does not match its digest")
                    rows.append({**row, "payload": body, "file": name, "offset": offset})
                    size += len(body or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


    def _whole(self, name: str, file) -> Iterator[tuple[int, dict, bytes | None]]:  # noqa: ANN001
        """The wanted records of a file, up to a damaged one."""
        try:
            yield from records(Window(file), lambda r: all(_accepts(c, r) for c in self.conditions), self.payload)
        except DamagedArchive as e:
            if self.damaged == "error":
                raise DamagedArchive(f"{name}: {e}") from None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.file_bytes = int(options.get("file_bytes", 256 << 20))
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _split(self.path)
        store.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, 256):
                    for row in batch.slice(start, 256).to_pylist():
                        if out is None:
                            names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                            out, size = store.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                        packed = member(record_bytes(row), self.level)
                        out.write(packed)
                        size += len(packed)
                        if size >= self.file_bytes:
                            out.close()
                            out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _split(self.path)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/_manifest-{uuid.uuid4().hex}") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of an unfinished job stay unlisted; a reader passes over them."""


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:  # noqa: ANN001
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:  # noqa: ANN001
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with filter pushdown to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages ------------------------------------------------------------------------------

def page_records(pages: DataFrame) -> DataFrame:
    """WARC rows of pages (``page_id``, ``url``, ``html``), equal payloads stored once.

    Of equal payloads the page with the largest id is the response and the
    others revisit it (rows that tie on the largest id, and pages without any id to
    refer to, are all responses). The digests are aggregated before the
    pages are shuffled, and the narrow side of the join is the hashed one.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = rows.groupBy("digest").agg(F.max("page_id").alias("kept_id"))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("kept_id")), F.lit(False))
    # Base 32 of the digest: four letters of each 20 bits.
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    base32 = F.concat(F.lit("sha1:"), *[
        F.substring(letters, F.expr(
            f"cast(shiftright(cast(conv(substring(digest, {i + 1}, 5), 16, 10) as int), {shift}) & 31 as int) + 1"), F.lit(1))
        for i in range(0, 40, 5) for shift in (15, 10, 5, 0)])
    uri = F.concat(F.lit("<urn:page:"), F.col("kept_id").cast("string"), F.lit(">"))
    return rows.join(first.hint("shuffle_hash"), "digest").select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, uri).alias("refers_to"),
        base32.alias("payload_digest"),
        F.map_filter(F.create_map(
            F.lit("X-Page-Id"), F.col("page_id").cast("string"),
            F.lit("X-Payload-Length"), F.length("payload").cast("string")), lambda _, v: v.isNotNull()).alias("fields"),
        F.when(~revisit, F.col("payload")).otherwise(F.lit(b"")).alias("payload"))


def archive_pages(pages: DataFrame, path: str) -> None:
    """Write the pages as WARC files under ``path``."""
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True, verify: bool = False,
              damaged: str = "error") -> DataFrame:
    """Records under ``path``; filter it on header columns to have them pushed down."""
    register(spark)
    return (spark.read.format("warc").option("payload", str(payload).lower())
            .option("verify", str(verify).lower()).option("damaged", damaged).load(path))


def page_index(records_: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of page records."""
    revisit = F.col("warc_type") == "revisit"
    return records_.select(
        F.col("fields")["X-Page-Id"].cast("long").alias("page_id"),
        F.when(revisit, F.col("fields")["X-Payload-Length"].cast("long"))
        .otherwise(F.length("payload").cast("long")).alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
        F.col("target_uri").alias("url"))
