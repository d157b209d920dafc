"""WARC archives as a Spark data source, and pages through them.

Reading plans partitions from files, takes over predicates on the record's type and other headers,
and parses a record's headers first: the block of a record that is not wanted is passed over, by
seeking where the file is not compressed. Writing gives every task one archive under a name of its
own and, when all are done, a manifest with the names that count, so lost attempts do no harm.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from moonstride.session import scratch_path

MANIFEST = "_archives.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPLIT_BYTES = 64 << 20

# column -> header it stands for
HEADERS = {
    "warc_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in HEADERS])
SCHEMA = SCHEMA.add("payload_bytes", "long").add("payload", "binary")
_ARROW = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, HTTP headers and, unless it is a revisit, the payload."""
    payload = row["payload"] or b""
    size = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row["warc_type"] == "revisit"
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": row["warc_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": row["date"],
        "WARC-Target-URI": row["target_uri"], "WARC-Payload-Digest": row["payload_digest"], "WARC-Refers-To": row["refers_to"],
        "WARC-Profile": REVISIT_PROFILE if revisit else None, "Content-Type": row["content_type"], "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in headers.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(stream: io.BufferedReader, name: str) -> dict[str, str] | None:
    """Headers of the next record, names in lower case; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{name}: no record begins with {line[:40]!r}")
    out: dict[str, str] = {}
    last = None
    while (line := stream.readline()).strip():
        if line[:1] in b" \t" and last:  # goes on from the line before
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        key, _, value = line.decode("utf-8", "replace").partition(":")
        last = key.strip().lower()
        out[last] = value.strip()
    if not line:
        raise ValueError(f"{name}: cut off within headers")
    return out


def _skip(stream: io.BufferedReader, size: int, plain: bool) -> None:
    if plain:
        stream.seek(size, io.SEEK_CUR)
        return
    while size:
        got = len(stream.read(min(size, 1 << 20)))
        if not got:
            raise ValueError("cut off within a block")
        size -= got


def _http(block: bytes) -> tuple[bytes, bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return head, body


def _length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == b"content-length":
            return int(value)
    return None


def _passes(condition: Filter, row: dict[str, str | None]) -> bool:
    value = row[condition.attribute[0]]
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, EqualNullSafe):
        return value == condition.value
    if value is None:
        return False
    if isinstance(condition, EqualTo):
        return value == condition.value
    if isinstance(condition, In):
        return value in condition.value
    if isinstance(condition, StringStartsWith):
        return value.startswith(condition.value)
    if isinstance(condition, StringEndsWith):
        return value.endswith(condition.value)
    return condition.value in value if isinstance(condition, StringContains) else True


_TAKEN = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)


@dataclass
class Archives(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    """Options: ``payload`` (true: hand out payloads), ``verify`` (false: compare payloads with their digests)."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.split = int(options.get("splitbytes", _SPLIT_BYTES))
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if isinstance(condition, _TAKEN) and len(condition.attribute) == 1 and condition.attribute[0] in HEADERS:
                self.conditions.append(condition)
            else:
                yield condition

    def partitions(self) -> list[Archives]:
        store, place = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(place)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(place, recursive=True))
        by_name = {f.path: f for f in found}
        manifest = by_name.get(f"{place}/{MANIFEST}")
        if manifest:
            with store.open_input_stream(manifest.path) as data:
                files = [by_name[f"{place}/{name}"] for name in json.loads(data.read())]
        else:
            files = [f for f in found if f.path.endswith((".warc", ".warc.gz"))]
        parts, size = [], 0
        for file in sorted(files, key=lambda f: -f.size):
            if not parts or size + file.size > self.split:
                parts.append(Archives([]))
                size = 0
            parts[-1].files.append(file.path)
            size += file.size
        return parts or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows: list[dict] = []
        held = 0
        for name in partition.files:
            with store.open_input_file(name) as data:
                plain = not name.endswith(".gz")
                stream = io.BufferedReader(data if plain else gzip.GzipFile(fileobj=data), 1 << 18)
                for row in self._records(stream, name, plain):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def _records(self, stream: io.BufferedReader, name: str, plain: bool) -> Iterator[dict]:
        while (headers := _headers(stream, name)) is not None:
            size = int(headers.get("content-length", 0))
            row: dict = {c: headers.get(h) for c, h in HEADERS.items()}
            if not all(_passes(c, row) for c in self.conditions):
                _skip(stream, size, plain)
                continue
            http = (row["content_type"] or "").startswith("application/http")
            revisit = row["warc_type"] == "revisit"
            row |= {"payload_bytes": None if http else size, "payload": None}
            if http or self.payload or self.verify:
                block = stream.read(size)
                if len(block) < size:
                    raise ValueError(f"{name}: cut off within a block")
                head, body = _http(block) if http else (b"", block)
                row["payload_bytes"] = _length(head) if http and revisit else len(body)
                if self.verify and not revisit and row["payload_digest"] and row["payload_digest"] != digest_of(hashlib.sha1(body).hexdigest()):
                    raise ValueError(f"{name}: {row['record_id']} does not match its digest")
                row["payload"] = body if self.payload and not revisit else None
            else:
                _skip(stream, size, plain)
            yield row


def digest_of(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceArrowWriter):
    """One archive per task. Option ``compression``: gzip (default; a member per record) or none."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.gzip = options["path"], options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, place = fs.FileSystem.from_uri(self.path)
        store.create_dir(place, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
        out = None
        for batch in iterator:
            for first in range(0, batch.num_rows, 100):
                for row in batch.slice(first, 100).to_pylist():
                    out = out or store.open_output_stream(f"{place}/{name}", compression=None)
                    content = record_bytes(row)
                    out.write(gzip.compress(content, 1, mtime=0) if self.gzip else content)
        if out:
            out.close()
        return Written(name if out else None)

    def commit(self, messages: list[Written | None]) -> None:
        store, place = fs.FileSystem.from_uri(self.path)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{MANIFEST}") as out:
            out.write(json.dumps(sorted(m.name for m in messages if m and m.name)).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, place = fs.FileSystem.from_uri(self.path)
        for message in messages:
            if message and message.name:
                store.delete_file(f"{place}/{message.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``warc`` a format of the session, with predicates handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records (``SCHEMA``) of ``page_id``, ``url``, ``html``; of equal payloads, the smallest id's is the response.

    Payloads are compared by SHA-1; those of fewer than ``min_bytes`` are all responses. Payloads held once need no
    partner, so only repeated digests are joined, after being counted where they are.

    A null html is an empty payload, a null url is left out. Rows that repeat the smallest id are responses
    too; a null id comes after all others, and if all ids of a payload are null all are responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= min_bytes)
    repeated = large.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(repeated.select(F.col("sha1").alias("_sha1"), "first"), F.col("sha1") == F.col("_sha1"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("null")), F.lit(">"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(F.lit("sha1:"), _base32("sha1")).alias("payload_digest"),
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.lit("application/http;msgtype=response").alias("content_type"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _base32(hex_column: str):
    """Base 32 of 20 bytes given as 40 hex digits: four groups of five bytes, eight letters each."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = []
    for group in range(4):
        value = F.conv(F.substring(hex_column, group * 10 + 1, 10), 16, 10).cast("long")
        for place in range(8):
            at = F.shiftright(value, 35 - 5 * place).bitwiseAND(F.lit(31)).cast("int")
            groups.append(F.substring(F.lit(letters), at + 1, F.lit(1)))
    return F.concat(*groups)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip") -> None:
    register(pages.sparkSession)
    page_records(pages, min_bytes).write.format("warc").mode("append").option("path", path).option("compression", compression).save()


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def page_of(column: str):
    """The page id in a record id; null if there is none."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def pages_through_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Per page: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, read back from archives.

    Payloads of responses are compared with their digests on reading and not handed out. See
    ``page_records`` for nulls and repeated rows; an empty table gives none.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path, min_bytes)
    records = read_archives(spark, path, payload="false", verify="true").where(F.col("warc_type").isin("response", "revisit"))
    return records.select(
        page_of("record_id").alias("page_id"), "payload_bytes",
        F.substring("payload_digest", 6, 32).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), page_of("refers_to").alias("refers_to"),
    )
