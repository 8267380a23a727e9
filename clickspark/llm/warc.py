"""WARC archives: a writer, and a Python data source that reads them.

A record's payload is what follows the HTTP header of a response. A revisit
record has the header only and names the record whose payload is the same.
Compressed archives have a gzip member per record; the writer notes each
member's length in its gzip header ("sl" extra field), so that the reader can
go past a record after it has seen the record's header.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)

from clickspark.llm.storage import created, listed, make_folder, opened, size_of
from clickspark.sources.shared import materialize

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
FIELDS = {
    "record_type": "string",
    "record_id": "string",
    "target_uri": "string",
    "date": "string",
    "payload_digest": "string",
    "refers_to": "string",
    "payload_length": "long",
    "headers": "map<string,string>",
    "payload": "binary",
}
SCHEMA = ", ".join(f"{k} {v}" for k, v in FIELDS.items())
_PEEK = 4096
_BATCH_BYTES = 1 << 23


# Writing


def page_records(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 1000,
) -> DataFrame:
    """One record per page, payload its html in UTF-8 (null: empty).

    Of pages with equal payloads of ``least_bytes`` or more (equal in length and
    SHA-1), that of the largest id is the response and the others revisit it; a
    row that repeats the largest id is a response too. All other pages are
    responses. A page without an id is named so and never revisited, unless the
    whole group has none. Payloads are compared by digest: only pairs of id and
    digest are grouped, and only groups of several are joined back.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.col(url).cast("string").alias("target_uri"),
        payload.alias("payload"),
        F.sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_length"),
    )
    groups = materialize(
        rows.where(F.col("payload_length") >= least_bytes)
        .groupBy("payload_digest", "payload_length")
        .agg(F.max("id").alias("leader"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and leader is not null")
        .drop("n"),
        "payload-groups",
    )
    joined = rows.join(groups, ["payload_digest", "payload_length"], "left")
    revisits = F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader"))
    return joined.select(
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        _name(F.col("id")).alias("record_id"),
        "target_uri",
        "payload_digest",
        F.when(revisits, _name(F.col("leader"))).alias("refers_to"),
        "payload_length",
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(record_id: Column) -> Column:
    """The page id in a record's id; null if it had none."""
    return F.when(
        ~record_id.endswith(":none"), F.substring_index(record_id, ":", -1).cast("long")
    )


def _clean(value: str) -> str:
    """Header values stay on one line: control characters are percent-encoded."""
    if value.isprintable():
        return value
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def encode_record(row: dict) -> bytes:
    """A record as it stands in an archive that is not compressed."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {row['payload_length']}\r\n\r\n"
    block = http.encode() + (row["payload"] or b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if row["refers_to"]:
        head += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
    head += [
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 24 + len(body) + 8
    if max(whole, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, whole, len(data))
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra))
    return head + extra + body + tail


def write_warc(
    records: DataFrame, path: str, compress: bool = True, level: int = 1, most_bytes: int = 1 << 28
) -> DataFrame:
    """Archives under ``path``, at least one per task; a new one begins after
    ``most_bytes``. Columns as ``page_records`` makes them. Returns ``file`` and
    ``n_records``. A task that runs again replaces its archives.
    """
    suffix = ".warc.gz" if compress else ".warc"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.to_pylist())
        row, number = next(rows, None), 0
        while row is not None:
            name, n, size = f"{path}/part-{part:06d}-{number:04d}{suffix}", 0, 0
            with created(name) as out:
                while row is not None and size < most_bytes:
                    data = encode_record(row)
                    data = gzip_member(data, level) if compress else data
                    out.write(data)
                    n, size, row = n + 1, size + len(data), next(rows, None)
            number += 1
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n]})

    make_folder(path)
    columns = [c for c in FIELDS if c in records.columns]
    return materialize(
        records.select(*columns).mapInArrow(run, "file string, n_records long"), "warc-files"
    )


# Reading


@dataclass
class Files(InputPartition):
    names: list[str]

    def __init__(self, names: list[str]):
        self.names = names


def _digest(value: str | None) -> str | None:
    """A SHA-1 in lower-case hex, from hex or base 32; others as they are."""
    if value is None or not value.lower().startswith("sha1:"):
        return value
    bare = value[5:]
    return base64.b32decode(bare.upper()).hex() if len(bare) == 32 else bare.lower()


def _parse(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines are joined, the last of
    repeated ones counts."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value is not None else None


class Record:
    """A record whose header is parsed; ``block`` reads the rest on demand."""

    def __init__(self, head: bytes, block):
        self.fields = _parse(head)
        self.block = block

    def row(self, with_payload: bool) -> dict:
        get = self.fields.get
        row = {
            "record_type": get("warc-type"),
            "record_id": _bare(get("warc-record-id")),
            "target_uri": get("warc-target-uri"),
            "date": get("warc-date"),
            "payload_digest": _digest(get("warc-payload-digest")),
            "refers_to": _bare(get("warc-refers-to")),
            "payload_length": None,
            "headers": list(self.fields.items()),
            "payload": None,
        }
        if get("content-type", "").startswith("application/http"):
            http, begins = _http_header(self.block)
            length = _parse(http).get("content-length", "")
            whole = int(get("content-length", 0))
            if length.isdigit():
                row["payload_length"] = int(length)
            elif row["record_type"] != "revisit":  # what the record has after the header
                row["payload_length"] = max(0, whole - begins)
            payload = self.block(None)[begins:] if with_payload else b""
        elif with_payload:
            payload = self.block(None)
            row["payload_length"] = len(payload)
        else:
            row["payload_length"] = int(get("content-length", 0))
        if with_payload and row["record_type"] != "revisit":
            row["payload"] = payload
        return row


def _http_header(read: Callable[[int], bytes]) -> tuple[bytes, int]:
    """The HTTP header of a block, however long, and where the payload begins. Lines
    end in CR LF or, as some servers have it, in LF alone. A block without the empty
    line that ends a header is all header."""
    limit = _PEEK
    while True:
        block = read(limit)
        found = [(block.find(mark), len(mark)) for mark in (b"\r\n\r\n", b"\n\n")]
        found = [f for f in found if f[0] >= 0]
        if found:
            at, mark = min(found)
            return block[:at], at + mark
        if len(block) < limit:
            return block, len(block)
        limit *= 4


def _member(source, start: int) -> tuple[Record, int | Callable[[], int]]:
    """The record of the gzip member at ``start``, and where the next begins: a
    place if the member notes its length, else what finds it by inflating."""
    source.seek(start)
    first = source.read(_PEEK)
    noted = first[3] & 4 and first[12:14] == b"sl"
    whole = struct.unpack("<I", first[16:20])[0] if noted else None
    inflate = zlib.decompressobj(31)
    data = bytearray(inflate.decompress(first))  # grows in place
    at = start + len(first)

    def more(limit: int | None) -> None:
        nonlocal data, at
        while not inflate.eof and (limit is None or len(data) < limit):
            chunk = source.read(1 << 16 if limit is not None else 1 << 20)
            if not chunk:
                raise ValueError("archive ends within a record")
            at += len(chunk)
            data += inflate.decompress(chunk)

    while b"\r\n\r\n" not in data and not inflate.eof:
        more(len(data) + 1)
    cut = data.index(b"\r\n\r\n")
    head = bytes(data[:cut])
    length = int(_parse(head).get("content-length", 0))

    def block(limit: int | None) -> bytes:
        most = length if limit is None else min(length, limit)
        source.seek(at)
        more(cut + 4 + most)
        return bytes(data[cut + 4 : cut + 4 + most])

    if whole:
        return Record(head, block), start + whole

    def end() -> int:
        nonlocal at
        source.seek(at)
        while not inflate.eof:
            chunk = source.read(1 << 16)
            if not chunk:
                raise ValueError("archive ends within a record")
            at += len(chunk)
            inflate.decompress(chunk)
        return at - len(inflate.unused_data)

    return Record(head, block), end


def _plain(source, start: int) -> tuple[Record, int]:
    source.seek(start)
    data = source.read(_PEEK)
    while b"\r\n\r\n" not in data:
        chunk = source.read(_PEEK)
        if not chunk:
            raise ValueError("archive ends within a header")
        data += chunk
    cut = data.index(b"\r\n\r\n")
    length = int(_parse(data[:cut]).get("content-length", 0))

    def block(limit: int | None) -> bytes:
        source.seek(start + cut + 4)
        return source.read(length if limit is None else min(length, limit))

    return Record(data[:cut], block), start + cut + 4 + length + 4


def records_of(source, size: int) -> Iterator[Record]:
    """The records of an archive, in order. A record's block can be read until
    the next record is asked for."""
    start = 0
    while start < size:
        source.seek(start)
        packed = source.read(2) == b"\x1f\x8b"
        record, following = _member(source, start) if packed else _plain(source, start)
        yield record
        start = following() if callable(following) else following


class WarcReader(DataSourceReader):
    """Plans a task for each ``splitBytes`` of archives (an archive is not
    divided). Equality, membership and prefix tests of the columns that come
    from record headers are answered before anything else of a record is read."""

    HEADERS = {
        "record_type": lambda f: f.get("warc-type"),
        "record_id": lambda f: _bare(f.get("warc-record-id")),
        "target_uri": lambda f: f.get("warc-target-uri"),
        "date": lambda f: f.get("warc-date"),
        "payload_digest": lambda f: _digest(f.get("warc-payload-digest")),
        "refers_to": lambda f: _bare(f.get("warc-refers-to")),
    }

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.split = int(options.get("splitBytes", 1 << 27))
        self.tests: list = []

    def pushFilters(self, filters):
        for test in filters:
            name = test.attribute[0] if len(getattr(test, "attribute", ())) == 1 else None
            get = self.HEADERS.get(name)
            if get and isinstance(test, EqualTo):
                self.tests.append((get, lambda x, v=test.value: x == v))
            elif get and isinstance(test, In):
                self.tests.append((get, lambda x, v=frozenset(test.value): x in v))
            elif get and isinstance(test, StringStartsWith):
                self.tests.append((get, lambda x, v=test.value: x is not None and x.startswith(v)))
            elif get and isinstance(test, IsNotNull):
                self.tests.append((get, lambda x: x is not None))
            else:
                yield test

    def partitions(self):
        found, held = [[]], 0
        for name in listed(self.path, (".warc", ".warc.gz")):
            size = size_of(name)
            if found[-1] and held + size > self.split:
                found.append([])
                held = 0
            found[-1].append(name)
            held += size
        return [Files(names) for names in found]

    def read(self, partition):
        rows, held = [], 0
        for name in partition.names:
            with opened(name) as source:
                for record in records_of(source, size_of(name)):
                    if all(test(get(record.fields)) for get, test in self.tests):
                        rows.append(record.row(self.payload))
                        held += 500 + len(rows[-1]["payload"] or b"")
                        if held >= _BATCH_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {
        "string": pa.string(), "long": pa.int64(), "binary": pa.binary(),
        "map<string,string>": pa.map_(pa.string(), pa.string()),
    }
    arrays = [pa.array([r[k] for r in rows], kinds[v]) for k, v in FIELDS.items()]
    return pa.RecordBatch.from_arrays(arrays, list(FIELDS))


class WarcSource(DataSource):
    """``spark.read.format("warc")``: archives of a folder, or one of them.

    Options: ``path``; ``payload`` (default true; if false payloads are not
    decoded); ``splitBytes``. ``payload_length`` is the full payload's, which
    revisits state without having it.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(**options).load(path)
