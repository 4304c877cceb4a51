"""WARC archives packed in ZIP files: writing, and reading by ranges.

A task writes its records into ZIP files of bounded size: the WARC file (one gzip member a
record) and its index are stored members, not deflated, so that any record can be read from
the ZIP file by offset and length. The reader parses the end record, the ZIP64 records where
sizes ask for them, and the central directory, finds where the members' bytes begin, reads
the index, and then fetches records by range: nothing is extracted, and the records of one
archive are read by as many tasks as there are ranges.

Equal payloads are stored once: the record with the smallest page id is a response, the others
are revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgloom.session import materialized, scratch_path

from .common import map_arrow, numbered_parts, table

ARCHIVE_BYTES = 256 << 20
#: records next to each other are fetched together, up to so many bytes
RANGE_BYTES = 4 << 20
MIN_BYTES = 0
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def with_first(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with ``first``: the smallest page id of an equal payload, null for the page itself.

    Payloads under ``min_bytes`` bytes are never revisits; nor are pages without an id. Repeated rows of the smallest
    id are responses each.
    """
    html = F.coalesce("html", F.lit(""))
    marked = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    firsts = marked.where(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"))
    # joined by a computed key, so that a hot payload's rows can be split at run time
    firsts = firsts.select(F.concat("sha1", F.lit("=")).alias("key"), "first")
    joined = marked.withColumn("key", F.concat("sha1", F.lit("="))).join(firsts, "key", "left")
    return joined.select("page_id", "url", "html", "sha1", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("first"))


def record(page_id, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """One WARC record: a response, or a revisit of the page ``first``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": _DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe=_SAFE)
    if first is not None:
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{first}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """One ZIP file: records as they come, the index at the end."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = _filesystem(self.uri)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.warc = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id, url: str | None, payload: bytes, sha1: str, first) -> None:
        digest = base64.b32encode(bytes.fromhex(sha1)).decode()
        packed = zlib.compress(record(page_id, url, payload, digest, first), 1, 31)
        self.warc.write(packed)
        self.index.append((quote(url or "", safe=_SAFE), {"offset": self.size, "length": len(packed), "digest": f"sha1:{digest}"}))
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.warc.close()
        stamp = "".join(c for c in _DATE if c.isdigit())
        lines = [f"{key} {stamp} {json.dumps(entry)}\n" for key, entry in sorted(self.index, key=lambda x: (x[0], x[1]["offset"]))]
        self.zip.writestr(INDEX_MEMBER, "".join(lines))
        self.zip.close()
        self.out.close()
        return self.uri, len(lines)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``with_first`` as archives under ``folder``; returns (archive, records), stored.

    A task that is run again writes new files; only files in the returned table count.
    """

    def run(batches):
        writer, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                columns = (piece.column(n).to_pylist() for n in ("page_id", "url", "html", "sha1", "first"))
                for page_id, url, html, sha1, first in zip(*columns):
                    if writer is None:
                        writer = ArchiveWriter(folder)
                    writer.add(page_id, url, html.encode(), sha1, first)
                    if writer.size >= archive_bytes:
                        done.append(writer.close())
                        writer = None
        if writer is not None:
            done.append(writer.close())
        for uri, n in done:
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64())], ["archive", "records"])

    spark = pages.sparkSession
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(target)
    return materialized(map_arrow(pages, run, "archive string, records long"), "archives")


class ZipDirectory:
    """Members of a ZIP file by name: (where the member's bytes begin, their number). Stored members only are listed."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        start, length, entries = self._end()
        self.members: dict[str, tuple[int, int]] = {}
        data, at = self._read(start, length), 0
        for _ in range(entries):
            magic, method, packed, size, n_name, n_extra, n_note, offset = struct.unpack("<I6xH8xIIHHH8xI", data[at : at + 46])
            if magic != 0x02014B50:
                raise ValueError("the central directory is damaged")
            name = data[at + 46 : at + 46 + n_name].decode("utf-8")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            size, packed, offset = self._zip64(extra, size, packed, offset)
            if method == 0:
                head = self._read(offset, 30)
                self.members[name] = (offset + 30 + sum(struct.unpack("<HH", head[26:30])), packed)
            at += 46 + n_name + n_extra + n_note

    def _read(self, start: int, length: int) -> bytes:
        return self.file.read_at(length, start)

    def _end(self) -> tuple[int, int, int]:
        """(start, length, entries) of the central directory."""
        base = max(0, self.size - (1 << 16) - 22)
        tail = self._read(base, self.size - base)
        at = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
        while at >= 0 and at + 22 + struct.unpack("<H", tail[at + 20 : at + 22])[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at + 3)  # the mark may stand in the file's comment
        if at < 0:
            raise ValueError("no ZIP file")
        entries, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            locator = self._read(base + at - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            wide = self._read(struct.unpack("<Q", locator[8:16])[0], 56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record")
            entries, length, start = struct.unpack("<QQQ", wide[32:56])
        return start, length, entries

    @staticmethod
    def _zip64(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int, int]:
        """Values of 0xFFFFFFFF stand in the ZIP64 field, in this order."""
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                size, packed, offset = (next(wide) if x == 0xFFFFFFFF else x for x in (size, packed, offset))
            extra = extra[4 + n :]
        return size, packed, offset


def locate_records(archives: DataFrame) -> DataFrame:
    """(archive, offset, length) of every record, from each archive's directory and index."""

    def run(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                store, path = _filesystem(uri)
                with store.open_input_file(path) as file:
                    members = ZipDirectory(file).members
                    start, length = members[INDEX_MEMBER]
                    base = members[WARC_MEMBER][0]
                    entries = [json.loads(x.split(" ", 2)[2]) for x in file.read_at(length, start).decode().splitlines()]
                for at in range(0, len(entries), 10_000):
                    some = entries[at : at + 10_000]
                    arrays = [[uri] * len(some), [base + e["offset"] for e in some], [e["length"] for e in some]]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["archive", "offset", "length"])

    return map_arrow(archives.select("archive"), run, "archive string, offset long, length long")


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, list[int]]]:
    """Records in order, joined to (archive, start, record lengths) while they touch."""
    archive, start, lengths = None, 0, []
    for a, offset, length in rows:
        if lengths and (a != archive or offset != start + sum(lengths) or sum(lengths) + length > RANGE_BYTES):
            yield archive, start, lengths
            lengths = []
        if not lengths:
            archive, start = a, offset
        lengths.append(length)
    if lengths:
        yield archive, start, lengths


def parse_record(packed: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of a gzip member."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def read_records(located: DataFrame) -> DataFrame:
    """Fetch records by range: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    A response whose payload does not have its digest is an error. A revisit has no payload; its size and digest
    are those the record states.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def run(batches):
        number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
        for batch in batches:
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("archive", "offset", "length"))))
            opened: tuple[str, object] = ("", None)
            for uri, start, lengths in _ranges(rows):
                if opened[0] != uri:
                    store, path = _filesystem(uri)
                    opened = (uri, store.open_input_file(path))
                data, at, out = opened[1].read_at(sum(lengths), start), 0, []
                for length in lengths:
                    fields, http, payload = parse_record(data[at : at + length])
                    at += length
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    is_response = fields["WARC-Type"] == "response"
                    if is_response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"a payload differs from its digest: {fields['WARC-Record-ID']} in {uri}")
                    url = fields.get("WARC-Target-URI")
                    out.append((
                        number(fields["WARC-Record-ID"]), None if url is None else unquote(url), fields["WARC-Type"],
                        number(fields.get("WARC-Refers-To")), int(http["Content-Length"]), digest, payload if is_response else None,
                    ))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    # sized by the bytes of the records, of which the index rows tell nothing
    located = materialized(located.select("archive", "offset", "length"), "warc-index")
    size = located.agg(F.sum("length")).first()[0] or 0
    parts = numbered_parts(located.sparkSession, size, RANGE_BYTES)
    spread = located.withColumn("range", F.expr(f"offset div {RANGE_BYTES}")).repartition(parts, "archive", "range")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return map_arrow(spread.sortWithinPartitions("archive", "offset").drop("range"), run, schema)


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(with_first(table(spark, sf_dir, "pages")), scratch_path(spark, "warc"))
    return read_records(locate_records(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha1 FROM pages
), firsts AS (
  SELECT sha1, min(page_id) AS first FROM payloads GROUP BY sha1
), digests AS (
  SELECT sha1, array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    (1 + 16 * b[5 * i + 1]::INT + 8 * b[5 * i + 2]::INT + 4 * b[5 * i + 3]::INT + 2 * b[5 * i + 4]::INT + b[5 * i + 5]::INT)::INT
  ]), '') AS digest
  FROM (SELECT sha1, unhex(sha1)::BIT::VARCHAR AS b FROM firsts)
)
SELECT page_id, payload_bytes, digest AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads JOIN firsts USING (sha1) JOIN digests USING (sha1)
"""
