"""WARC files as a PySpark data source, read and written.

Reading: files are planned as partitions of bounded size. Of each record the header block is
parsed first; filters on record type and other header columns are pushed down and decided there,
and the payload of a record that fails them, or that the query does not ask for, is not decoded.
A gzip member may hold one record or many. Members written here hold one and carry their length in
an "sl" extra field, so a skipped record is skipped by a seek; other members are inflated and
dropped. Plain files are skipped by Content-Length. Subfolders are read too.

Writing: each task writes files of its own and a commit lists them, so files of failed or
repeated attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage)

from .common import materialize, scratch_dir

#: Header fields as columns. Fixed names of the WARC format.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_length": "content-length"}
SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, payload_digest string, refers_to string, "
          "content_length long, payload_length long, payload binary")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of files in a partition, and from which on a writer begins another file.
PARTITION_BYTES, FILE_BYTES = 128 << 20, 256 << 20
LEVEL = 4
#: Names of the files written here.
WRITTEN = re.compile(r"[0-9a-f]{32}\.warc\.gz")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32_sha1_column(payload: Column) -> Column:
    """Base-32 SHA-1 in column functions: five hex digits at a time are four base-32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _clean(value: str | None) -> str:
    return " ".join((value or "").split())


def record_bytes(record_type: str, record_id: str, target_uri: str | None, date: str, payload: bytes | None,
                 payload_length: int, digest: str, refers_to: str | None) -> bytes:
    """One record. A revisit's block is the response's HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_length}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_clean(record_id)}", f"WARC-Date: {date}"]
    if target_uri is not None:
        lines.append(f"WARC-Target-URI: {_clean(target_uri)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_clean(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose "sl" extra field has its own length and the length of ``data``."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded line
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class Records:
    """The records of one open file: (header, read_block) pairs. A block that is not asked for is
    skipped. ``inflated`` counts the bytes inflated, for tests."""

    CHUNK = 16 << 10

    def __init__(self, f, compressed: bool):
        self.f, self.compressed, self.inflated = f, compressed, 0

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        return self._members() if self.compressed else self._plain()

    def _plain(self):
        at, size = 0, self.f.size()
        while at < size:
            self.f.seek(at)
            data = b""
            while (end := data.find(b"\r\n\r\n")) < 0:
                more = self.f.read(self.CHUNK)
                if not more:
                    if data.strip():
                        raise ValueError(f"a record header breaks off at byte {at}")
                    return
                data += more
                if not data.strip():
                    at, data = at + len(data), b""
            lead = len(data) - len(data.lstrip(b"\r\n"))
            header = parse_header(data[lead:end]) if end > lead else None
            if header is None:  # blank lines between records
                at += lead
                continue
            start, length = at + end + 4, int(header["content-length"])

            def block(start=start, length=length):
                self.f.seek(start)
                return self.f.read(length)

            yield header, block
            at = start + length + 4

    def _members(self):
        at, size = 0, self.f.size()
        while at < size:
            member = _Member(self, at)
            while (end := member.find_header()) is not None:
                header = parse_header(bytes(member.data[:end]))
                member.drop(end + 4)
                last = member.position + int(header["content-length"])
                yield header, lambda member=member, last=last: member.read(last - member.position)
                if member.packed and member.whole <= last + 4:
                    break  # nothing behind this record: the member's rest is skipped by its length
                member.skip(last - member.position)
            if member.packed:
                at += member.packed
            else:  # the member's end shows only when all of it is inflated
                at = self.f.tell() - len(member.state.unused_data) + 8

    @staticmethod
    def _gzip_header(data: bytes) -> tuple[int, int, int]:
        """Length of the gzip header, and of the whole member packed and inflated if an "sl" field
        tells them (else 0)."""
        flags, at, packed, whole = data[3], 10, 0, 0
        if flags & 4:
            (extra,) = struct.unpack_from("<H", data, at)
            field, end = at + 2, at + 2 + extra
            while field + 4 <= end:
                name, size = data[field:field + 2], struct.unpack_from("<H", data, field + 2)[0]
                if name == b"sl" and size >= 8:
                    packed, whole = struct.unpack_from("<II", data, field + 4)
                field += 4 + size
            at = end
        for flag in (8, 16):
            if flags & flag:
                at = data.index(b"\x00", at) + 1
        return at + (2 if flags & 2 else 0), packed, whole


class _Member:
    """The inflated bytes of one gzip member, read forward. ``data`` is what is inflated and not
    yet used, ``position`` the place of its first byte in the member."""

    def __init__(self, records: Records, at: int):
        self.records, self.at, self.position, self.data = records, at, 0, bytearray()
        records.f.seek(at)
        data = records.f.read(Records.CHUNK)
        if data[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        skip, self.packed, self.whole = Records._gzip_header(data)
        self.state, self.pending = zlib.decompressobj(-15), data[skip:]

    def more(self, limit: int) -> bool:
        """Inflates a piece of at most ``limit`` bytes; False at the member's end."""
        if self.state.eof:
            return False
        data = self.pending or self.records.f.read(1 << 18 if limit > Records.CHUNK else Records.CHUNK)
        if not data:
            raise ValueError(f"the member at byte {self.at} breaks off")
        piece = self.state.decompress(data, limit)
        self.pending = self.state.unconsumed_tail
        self.records.inflated += len(piece)
        self.data += piece
        return True

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.position += n

    def find_header(self) -> int | None:
        """Where the next record's header ends, blank lines before it dropped; None behind the last record."""
        seen = 0
        while True:
            self.drop(len(self.data) - len(self.data.lstrip(b"\r\n")))
            end = self.data.find(b"\r\n\r\n", max(0, seen - 3))
            if end >= 0:
                return end
            seen = len(self.data)
            if not self.more(Records.CHUNK):
                if self.data:
                    raise ValueError(f"a record header breaks off in the member at byte {self.at}")
                return None

    def read(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self.more(1 << 20):
                raise ValueError(f"a record breaks off in the member at byte {self.at}")
        block = bytes(self.data[:n])
        self.drop(n)
        return block

    def skip(self, n: int) -> None:
        while len(self.data) < n:
            n -= len(self.data)
            self.drop(len(self.data))
            if not self.more(1 << 20):
                raise ValueError(f"a record breaks off in the member at byte {self.at}")
        self.drop(n)


def http_payload(block: bytes) -> tuple[bytes, int | None]:
    """The payload of an HTTP response and the length its header states."""
    head, sep, body = block.partition(b"\r\n\r\n")
    length = None
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            length = int(value)
    return (body if sep else b""), length


def _split_uri(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else fs.FileSystem.from_uri(f"file:{path}")


@dataclass
class Files(InputPartition):
    paths: list


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns = [f.name for f in schema.fields]
        self.options = options
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual,
                                                  LessThan, LessThanOrEqual, StringStartsWith)):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        system, root = _split_uri(self.options["path"])
        info = system.get_file_info(root)
        if info.type == fs.FileType.File:
            found = [(root, info.size)]
        else:
            found = self._archives(system, root)
        parts, have = [], PARTITION_BYTES
        for p, s in sorted(found):
            if have + s > PARTITION_BYTES and (not parts or have):
                parts.append([])
                have = 0
            parts[-1].append(p)
            have += s
        return [Files(p) for p in parts] or [Files([])]

    @staticmethod
    def _archives(system, root: str) -> list[tuple[str, int]]:
        """Archives below a folder, of subfolders too (not of those whose name begins with "_" or
        "."). In a folder that holds commits, files named as this writer names them count only if a
        commit lists them; all other archives are read."""
        listed: dict[str, set] = {}
        files = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            folder, _, name = info.path.rpartition("/")
            inner = folder[len(root.rstrip("/")):].split("/")
            if info.type != fs.FileType.File or any(part[:1] in ("_", ".") for part in inner if part):
                continue
            if name.startswith("_commit-"):
                with system.open_input_stream(info.path) as f:
                    listed.setdefault(folder, set()).update(json.loads(f.read()))
            elif name.endswith((".warc", ".warc.gz")) and name[:1] not in ("_", "."):
                files.append((folder, name, info.size))
        return [(f"{folder}/{name}", size) for folder, name, size in files
                if folder not in listed or name in listed[folder] or not WRITTEN.fullmatch(name)]

    def _passes(self, value_of) -> bool:
        for f in self.filters:
            v = value_of(f.attribute[0])
            if isinstance(f, IsNull):
                ok = v is None
            elif isinstance(f, IsNotNull):
                ok = v is not None
            elif isinstance(f, EqualNullSafe):
                ok = v == f.value
            elif v is None:
                ok = False
            elif isinstance(f, EqualTo):
                ok = v == f.value
            elif isinstance(f, In):
                ok = v in f.value
            elif isinstance(f, StringStartsWith):
                ok = v.startswith(f.value)
            else:
                ok = {GreaterThan: v.__gt__, GreaterThanOrEqual: v.__ge__, LessThan: v.__lt__, LessThanOrEqual: v.__le__}[type(f)](f.value)
            if not ok:
                return False
        return True

    def read(self, partition):
        system, _ = _split_uri(self.options["path"])
        verify = self.options.get("verify", "false").lower() == "true"
        want = set(self.columns)
        for path in partition.paths:
            with system.open_input_file(path) as f:
                rows, held = [], 0
                for header, block in Records(f, path.endswith(".gz")):
                    def value_of(name):
                        v = header.get(HEADERS[name])
                        if v is None:
                            return None
                        return int(v) if name == "content_length" else v.removeprefix("sha1:") if name == "payload_digest" else v

                    if not self._passes(value_of):
                        continue
                    row = {c: value_of(c) for c in self.columns if c in HEADERS}
                    whole = value_of("record_type") == "response" and ("payload" in want or verify)
                    if whole or "payload_length" in want or "payload" in want:
                        payload, length = http_payload(block()) if header.get("content-type", "").startswith("application/http") else (block(), None)
                        full = value_of("record_type") != "revisit"
                        row["payload_length"] = len(payload) if full else length
                        row["payload"] = payload if full else None
                        if verify and full and value_of("payload_digest") not in (None, base32_sha1(payload)):
                            raise ValueError(f"{path}: the payload of {value_of('record_id')} does not match its digest")
                    rows.append([row.get(c) for c in self.columns])
                    held += len(row.get("payload") or b"") if "payload" in want else 200
                    if held > 8 << 20:
                        yield self._batch(rows)
                        rows, held = [], 0
                if rows:
                    yield self._batch(rows)

    def _batch(self, rows):
        kinds = {"content_length": pa.int64(), "payload_length": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds.get(c, pa.string())) for i, c in enumerate(self.columns)],
                                          names=self.columns)


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, payload, payload_length, payload_digest,
    refers_to) to .warc.gz files. The payload of a revisit is not written."""

    def __init__(self, options, overwrite: bool):
        if overwrite:
            raise ValueError("WARC archives are appended to; write to a new folder instead")
        self.options = options

    def write(self, iterator) -> Written:
        system, root = _split_uri(self.options["path"])
        system.create_dir(root, recursive=True)
        date = self.options.get("date", "1970-01-01T00:00:00Z")
        names, f, size = [], None, 0
        try:
            for batch in iterator:
                for r in batch.to_pylist():
                    if f is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        f, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                    member = gzip_member(record_bytes(r["record_type"], r["record_id"], r["target_uri"], date, r["payload"],
                                                      r["payload_length"], r["payload_digest"], r["refers_to"]))
                    f.write(member)
                    size += len(member)
                    if size >= FILE_BYTES:
                        f.close()
                        f = None
        finally:
            if f is not None:
                f.close()
        return Written(names)

    def commit(self, messages) -> None:
        system, root = _split_uri(self.options["path"])
        system.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with system.open_output_stream(f"{root}/_commit-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        system, root = _split_uri(self.options["path"])
        for m in messages:
            for n in m.names if m is not None else ():
                system.delete_file(f"{root}/{n}")


class WarcDataSource(DataSource):
    """Format "warc". Options: path; verify ("true": fail on a payload that does not match its
    digest); date (of written records). A schema of some of the columns may be given; without
    ``payload`` and ``payload_length`` in it, and without verify, no payload is decoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", uri_col: str = "url",
                  text_col: str = "html") -> DataFrame:
    """Pages to records: of equal payloads (by SHA-1) of at least ``min_bytes`` bytes the largest id is the
    response and the others revisit it; smaller payloads are all responses.

    A null text is an empty payload. Rows that repeat the largest id with the same payload are
    all responses; a null id is smaller than any other, and if equal payloads have no other id
    they are all responses. Other columns are not looked at.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(uri_col).cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1_column(F.col("payload"))).withColumn("payload_length", F.octet_length("payload").cast("long"))
    # digests alone are counted; where few payloads repeat, the pages are not shuffled
    repeated = materialize(rows.filter(F.col("payload_length") >= min_bytes).groupBy("payload_digest").agg(
        F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1 and kept is not null").drop("n"))
    rows = rows.join(repeated, "payload_digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
        "target_uri", F.when(~revisit, F.col("payload")).alias("payload"), "payload_length", "payload_digest",
        F.when(revisit, urn(F.col("kept"))).alias("refers_to"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = scratch_dir(spark)
    with_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet")).write.format("warc").mode("append").save(path)
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_length long"
    back = spark.read.format("warc").schema(columns).option("verify", "true").load(path)

    def page(c):
        return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return back.select(page(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                       "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to"))


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest
  FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM m
"""
