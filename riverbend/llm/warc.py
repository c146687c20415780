"""WARC archives with a Zstandard dictionary: a Spark data source, and pages on top of it.

The data source ``riverbend_warc`` writes rows as WARC/1.1 records. Each task of a write makes
archives of about ``ARCHIVE_BYTES`` of records: it holds back the first ``TRAIN_BYTES`` of them,
builds a dictionary from these records, writes it compressed in a leading skippable frame (the
frame that readers of ``.warc.zst`` look for), then compresses every record as a frame of its
own. Whoever has the dictionary can read a record from its offset alone. Archives have names of
their own and count only once the write's manifest lists them: a lost executor's archives are
written again by another task, and what it left is never read. Reading gives one task an
archive, record by record, and checks each payload against its digest.

``archive`` writes a table of pages: of equal payloads the first is a response, the others are
revisits that refer to it. ``records`` reads a folder of archives back as pages.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import string
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from riverbend.llm.common import written
from riverbend.session import checkpoint_path

FORMAT = "riverbend_warc"
ARCHIVE_BYTES, TRAIN_BYTES, DICTIONARY_BYTES, LEVEL = 1 << 30, 8 << 20, 112_640, 3
BATCH_BYTES = 8 << 20
PIECE = 32  # bytes of a sample, where few records are cut up

# Fixed values of the formats.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http;msgtype=response"

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes bigint, payload binary")
CONTROL = re.compile(r"[\x00-\x20\x7f<>]")


def _line(name: str, value: str) -> str:
    # a control character would end the line; it is percent-encoded
    return f"{name}: {CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', value)}\r\n"


def record(row: dict, date: str) -> bytes:
    """One WARC record; a revisit carries the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + (row["payload"] or b"")
    head = [f"{VERSION}\r\n", _line("WARC-Type", row["record_type"]), f"WARC-Record-ID: <{row['record_id']}>\r\n",
            _line("WARC-Date", date)]
    if row["target_uri"] is not None:
        head.append(_line("WARC-Target-URI", row["target_uri"]))
    head.append(_line("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"))
    if row["refers_to"] is not None:
        head += [f"WARC-Refers-To: <{row['refers_to']}>\r\n", _line("WARC-Profile", REVISIT)]
    head += [f"Content-Type: {RESPONSE_TYPE}\r\n", f"Content-Length: {len(block)}\r\n\r\n"]
    return "".join(head).encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on the records, or on pieces of them where they are too few to train
    on (a header alone has enough); None if there are fewer bytes than that."""
    pieces = lambda: [r[a:a + step] for r in records for step in [max(PIECE, len(r) // 16)]
                      for a in range(0, len(r), step)]
    for samples, segment in ((lambda: records, 512), (pieces, PIECE)):
        try:
            return zstandard.train_dictionary(size, samples(), k=segment, d=8)
        except zstandard.ZstdError:
            pass
    return None


class Archive:
    """Writes one archive to a stream; a task holds its first ``train`` bytes at most."""

    def __init__(self, out, train: int = TRAIN_BYTES, level: int = LEVEL):
        self.out, self.train, self.level = out, train, level
        self.held: list[bytes] = []
        self.raw = self.records = 0
        self.compressor = None

    def add(self, data: bytes) -> None:
        self.raw += len(data)
        self.records += 1
        if self.compressor is not None:
            self.out.write(self.compressor.compress(data))
            return
        self.held.append(data)
        if self.raw >= self.train:
            self._begin()

    def _begin(self) -> None:
        trained = dictionary(self.held)
        if trained is not None:
            small = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(small)) + small)
            self.compressor = zstandard.ZstdCompressor(level=self.level, dict_data=trained, write_content_size=True)
        else:
            self.compressor = zstandard.ZstdCompressor(level=self.level, write_content_size=True)
        for data in self.held:
            self.out.write(self.compressor.compress(data))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.out.close()


def _lines(stream: io.BufferedReader) -> dict[str, str]:
    """Header fields up to the empty line, names in lower case."""
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def read_archive(raw) -> Iterator[dict]:
    """The records of an archive, as rows of ``SCHEMA``; a payload that differs from its digest,
    or a cut archive, raises ValueError."""
    head = raw.read(8)
    trained = None
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_FRAME:
            data = raw.read(size)
            if data[:4] == struct.pack("<I", ZSTD_FRAME):
                data = zstandard.ZstdDecompressor().decompress(data)
            trained, head = zstandard.ZstdCompressionDict(data), b""
    stream = io.BufferedReader(_Frames(zstandard.ZstdDecompressor(dict_data=trained), head, raw), 1 << 20)
    while (first := stream.readline()):
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = _lines(stream)
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is cut")
        body = io.BufferedReader(io.BytesIO(block))
        body.readline()  # status line
        http = _lines(body)
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        payload = body.read() if fields["warc-type"] == "response" else None
        if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record {fields['warc-record-id']} differs from its digest")
        refers = fields.get("warc-refers-to")
        yield {"record_id": fields["warc-record-id"][1:-1], "record_type": fields["warc-type"],
               "target_uri": fields.get("warc-target-uri"), "refers_to": refers and refers[1:-1],
               "payload_digest": digest, "payload_bytes": int(http["content-length"]), "payload": payload}


class _Frames(io.RawIOBase):
    """The content of the frames in ``head`` and the rest of ``raw``; the last one must be whole."""

    def __init__(self, opener: zstandard.ZstdDecompressor, head: bytes, raw):
        self.opener, self.rest, self.raw = opener, head, raw
        self.frame, self.out = None, b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.out:
            if not self.rest:
                self.rest = self.raw.read(1 << 18)
                if not self.rest:
                    if self.frame is not None:
                        raise ValueError("the archive ends inside a frame")
                    return 0
            self.frame = self.frame or self.opener.decompressobj()
            self.out, self.rest = memoryview(self.frame.decompress(self.rest)), b""
            if self.frame.eof:
                self.rest, self.frame = self.frame.unused_data, None
        n = min(len(into), len(self.out))
        into[:n] = self.out[:n]
        self.out = self.out[n:]
        return n


class Written(NamedTuple):
    name: str
    records: int
    raw: int


class Committed(WriterCommitMessage):
    def __init__(self, archives: list[Written]):
        self.archives = archives


class Part(InputPartition):
    """One archive."""


def _folder(options: dict) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(options["path"])


class Writer(DataSourceArrowWriter):
    """A task's rows into archives; the driver's commit lists them in a manifest."""

    def __init__(self, options: dict):
        self.options = options
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Committed:
        fs, root = _folder(self.options)
        fs.create_dir(root, recursive=True)
        limit = int(self.options.get("archivebytes", ARCHIVE_BYTES))
        train = int(self.options.get("trainbytes", TRAIN_BYTES))
        date = self.options.get("date", "1970-01-01T00:00:00Z")
        done, archive, name = [], None, ""
        for batch in iterator:
            for i in range(batch.num_rows):
                if archive is None:
                    name = f"{self.job}-{uuid.uuid4().hex}.warc.zst"
                    archive = Archive(fs.open_output_stream(f"{root}/{name}", compression=None), train)
                archive.add(record({f: batch.column(f)[i].as_py() for f in batch.schema.names}, date))
                if archive.raw >= limit:
                    archive.close()
                    done.append(Written(name, archive.records, archive.raw))
                    archive = None
        if archive is not None:
            archive.close()
            done.append(Written(name, archive.records, archive.raw))
        return Committed(done)

    def commit(self, messages: list[Committed | None]) -> None:
        fs, root = _folder(self.options)
        fs.create_dir(root, recursive=True)
        listed = [w._asdict() for m in messages if m is not None for w in m.archives]
        with fs.open_output_stream(f"{root}/_{self.job}.tmp") as out:
            out.write(json.dumps(listed).encode())
        fs.move(f"{root}/_{self.job}.tmp", f"{root}/manifest-{self.job}.json")

    def abort(self, messages: list[Committed | None]) -> None:
        """Archives that no manifest lists are never read."""


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Part]:
        fs, root = _folder(self.options)
        files = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        names = []
        for info in sorted(files, key=lambda x: x.path):
            if info.base_name.startswith("manifest-") and info.base_name.endswith(".json"):
                with fs.open_input_stream(info.path) as f:
                    names += [w["name"] for w in json.loads(f.read())]
        return [Part(n) for n in names] or [Part(None)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.value is None:  # no archives
            return
        fs, root = _folder(self.options)
        rows, size = [], 0
        with fs.open_input_stream(f"{root}/{partition.value}", compression=None) as raw:
            for row in read_archive(raw):
                rows.append(row)
                size += 256 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


ARROW = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                   ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload", pa.binary())])


class WarcSource(DataSource):
    """``spark.read.format("riverbend_warc").load(folder)`` and ``df.write.format(...)``.

    Rows are those of ``SCHEMA``. Options of a write: ``archiveBytes`` and ``trainBytes`` (of
    records before compression), ``date`` of the records. A write adds to the folder.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("archives are added to a folder, not overwritten: use mode('append')")
        return Writer({k.lower(): v for k, v in self.options.items()})


def _id(page: str, row: str):
    return F.concat(F.lit("urn:x-page:"), F.coalesce(F.url_encode(F.col(page).cast("string")), F.lit("")),
                    F.lit(":"), F.col(row).cast("string"))


def _page(record_id: str, kind: str):
    part = F.regexp_extract(record_id, "^urn:x-page:([^:]*):", 1)
    return F.when(part != "", F.url_decode(part)).cast(kind)


def _base32(sha1: str):
    """Hexadecimal SHA-1 in base 32: ten digits give eight, counted 0-9A-V and then renamed."""
    eights = [F.lpad(F.conv(F.substring(sha1, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*eights), string.digits + string.ascii_uppercase[:22], string.ascii_uppercase + "234567")


def marked(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
           payload_col: str = "html") -> DataFrame:
    """The pages as rows of ``SCHEMA``: of payloads of ``min_bytes`` or more that are equal (by
    SHA-1 and length), the one of the smallest id is a response and the others revisit it.

    A null payload counts as empty. Rows without id come after all others; of rows of equal id and
    payload one, no matter which, is the response.
    """
    data = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = written(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("target_uri"),
                                data.alias("payload"), F.sha1(data).alias("sha1"),
                                F.octet_length(data).cast("bigint").alias("payload_bytes"),
                                F.monotonically_increasing_id().alias("row")), "pages", "zstd")
    # Narrow and pre-aggregated; only payloads that repeat are joined, and a payload that very many
    # rows share is a skewed join, which adaptive execution splits.
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first")
    repeated = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1", "payload_bytes")
                .agg(first, F.count("*").alias("n")).where("n > 1")
                .select("sha1", "payload_bytes", F.col("first.row").alias("first_row"),
                        _id("first.page_id", "first.row").alias("refers")))
    joined = rows.join(repeated, ["sha1", "payload_bytes"], "left")
    again = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    return joined.select(_id("page_id", "row").alias("record_id"),
                         F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
                         F.when(again, F.col("refers")).alias("refers_to"),
                         _base32("sha1").alias("payload_digest"), "payload_bytes",
                         F.when(~again, F.col("payload")).alias("payload"))


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = 0, options: dict | None = None, **columns) -> str:
    """Write a record for every page; returns the folder (by default one of the shared folder).

    Empty table: a folder without archives. Extra columns are not written. ``columns``: the names
    ``id_col``, ``url_col`` and ``payload_col``.
    """
    spark = pages.sparkSession
    path = path or checkpoint_path(spark, f"riverbend-llm/warc-{uuid.uuid4().hex}")
    spark.dataSource.register(WarcSource)
    (marked(pages, min_bytes, **columns).write.format(FORMAT).mode("append").options(**(options or {})).save(path))
    return path


def records(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of every
    record of a folder that ``archive`` wrote. The payload of a revisit is null."""
    spark.dataSource.register(WarcSource)
    read = spark.read.format(FORMAT).load(path)
    return read.select(_page("record_id", id_type).alias("page_id"), F.col("target_uri").alias("url"),
                       "payload_bytes", "payload_digest", "record_type",
                       _page("refers_to", id_type).alias("refers_to"), "payload")
