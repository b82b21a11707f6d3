"""WARC archives as a Spark data source, written and read in parallel.

Reading plans partitions over ranges of files: a range has the gzip members, or in plain archives the records, that start in it. Headers are parsed
first; predicates on the record type and on header fields are pushed down to them, and the block of a record that they reject is
neither decoded nor kept. Our own members carry their compressed length in the gzip header (subfield `sl`), so such a
block is skipped without being decompressed; other archives' blocks are decompressed and thrown away.

A record whose Content-Length is missing or no number has a null block_bytes and ends where the next record or its member does.
Bytes that are neither a record nor a member are an error, never skipped.

Files are reached through pyarrow's file systems, so a path may be any URI that both driver and executors can open.
"""

from __future__ import annotations

import base64
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from concordat.llm.common import cut, ship, sieve, sifted, spread_join

SCHEMA = "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, refers_to string, block_bytes long, payload_bytes long, headers map<string,string>, payload binary"
SMALL_PAYLOAD = 1000
_LIMIT = 64 << 20


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (pa.fs.LocalFileSystem(), path)


def hex_digest(value: str | None) -> str | None:
    """A payload digest as bare lower-case hex; archives have `sha1:` and base 32 or hex."""
    if not value:
        return None
    kind, _, rest = value.rpartition(":")
    if kind.lower() == "sha1" and len(rest) == 32:
        return base64.b32decode(rest.upper()).hex()
    return rest.lower()


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


def _headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in re.sub(rb"\r?\n[ \t]+", b" ", raw).split(b"\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().decode("latin-1").lower(), value.strip().decode("utf-8", "replace"))
    return out


_FIELDS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type", "refers_to": "warc-refers-to"}


def _fields(headers: dict[str, str]) -> dict:
    row = {k: headers.get(v) for k, v in _FIELDS.items()}
    for k in ("record_id", "refers_to"):
        row[k] = row[k].strip("<>") if row[k] else row[k]
    row["payload_digest"] = hex_digest(headers.get("warc-payload-digest"))
    length = headers.get("content-length") or ""
    row["block_bytes"] = int(length) if re.fullmatch(r"\d{1,18}", length, re.ASCII) else None
    return row


def _holds(row: dict, f) -> bool:
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None or (not isinstance(f, In) and f.value is None):
        return False
    if isinstance(f, In):
        return value in f.value
    tests = {EqualTo: value.__eq__, GreaterThan: value.__gt__, GreaterThanOrEqual: value.__ge__, LessThan: value.__lt__, LessThanOrEqual: value.__le__}
    if type(f) in tests:
        return tests[type(f)](f.value)
    return {StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}[type(f)](value, f.value)


_PUSHED = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.step = int(options.get("rangebytes", _LIMIT))
        self.with_payload = str(options.get("payload", "true")).lower() != "false"
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, _PUSHED) and len(f.attribute) == 1 and f.attribute[0] in {*_FIELDS, "payload_digest", "block_bytes"}:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Range]:
        fs, path = _open(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pa.fs.FileType.File else fs.get_file_info(pa.fs.FileSelector(path, recursive=True, allow_not_found=True))
        out = []
        for f in sorted(found, key=lambda f: f.path):
            if f.type != pa.fs.FileType.File or "/_" in f.path[len(path) :] or not re.search(r"\.warc(\.gz)?$", f.path):
                continue
            out += [Range(f.path, lo, min(f.size, lo + self.step)) for lo in range(0, f.size, self.step)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark gives where no partitions are planned
            return
        fs, _ = _open(self.path)
        schema = _arrow_schema()
        rows: list[dict] = []
        held = 0
        with fs.open_input_file(part.path) as f:
            records = _gz_records(f, part, self._wanted) if part.path.endswith(".gz") else _plain_records(f, part, self._wanted)
            for headers, row, block in records:
                http, payload, length = _payload(row, block)
                row |= {"headers": list((headers | http).items()), "payload_bytes": length, "payload": payload if self.with_payload else None}
                rows.append(row)
                held += len(block)
                if held > 8 << 20 or len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _wanted(self, row: dict) -> bool:
        return all(_holds(row, f) for f in self.filters)


def _arrow_schema() -> pa.Schema:
    text, number = pa.string(), pa.int64()
    kinds = {"block_bytes": number, "payload_bytes": number, "headers": pa.map_(text, text), "payload": pa.binary()}
    names = ["record_id", "record_type", "target_uri", "date", "content_type", "payload_digest", "refers_to", "block_bytes", "payload_bytes", "headers", "payload"]
    return pa.schema([(n, kinds.get(n, text)) for n in names])


def _payload(row: dict, block: bytes) -> tuple[dict, bytes | None, int]:
    """HTTP headers, payload and full payload length of a block. A revisit has no payload; its HTTP headers have the length."""
    if "application/http" not in (row["content_type"] or ""):
        return {}, block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    http = {f"http-{k}": v for k, v in _headers(head).items()}
    if row["record_type"] == "revisit":
        length = http.get("http-content-length") or ""
        return http, None, int(length) if re.fullmatch(r"\d{1,18}", length, re.ASCII) else 0
    return http, body, len(body)


_NEXT = b"\r\n\r\nWARC/1."


class _Member:
    """The content of a gzip member, read in order from its first bytes `raw` and then from f."""

    def __init__(self, f, raw: bytes):
        self.f, self.raw, self.unzip, self.text = f, raw, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Add to text; False at the member's end."""
        raw = b"" if self.unzip.eof else self.raw or self.unzip.unconsumed_tail or self.f.read(1 << 16)
        self.raw = b""
        if raw:
            self.text += self.unzip.decompress(raw, 1 << 18)
        return bool(raw)

    def head(self) -> bytes:
        """The next record's header; empty if the member is used up."""
        while b"\r\n\r\n" not in (text := self.text.lstrip(b"\r\n")) and self.more():
            pass
        head, _, self.text = text.partition(b"\r\n\r\n")
        return head

    def take(self, n: int | None, keep: bool) -> bytes:
        """The next n bytes of content; without n, all before the next record or the end."""
        if n is None:
            while (at := self.text.find(_NEXT)) < 0 and self.more():
                pass
            n = at if at >= 0 else len(self.text)
        parts = []
        while n > 0 and (self.text or self.more()):
            piece, self.text = self.text[:n], self.text[n:]
            n -= len(piece)
            if keep:
                parts.append(piece)
        return b"".join(parts)


def _gz_records(f, part: Range, wanted) -> Iterator[tuple[dict, dict, bytes]]:
    """The records of the members that start in the range; a member may hold any number of them."""
    at = _first_member(f, part) if part.start else 0
    while at is not None and at < part.end:
        f.seek(at)
        raw = f.read(1 << 14)
        if not raw:
            return
        if len(raw) < 18 or raw[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {at} of the archive")
        stated = struct.unpack_from("<II", raw, 16) if raw[3] & 4 and raw[12:14] == b"sl" else (0, 0)
        member, passed = _Member(f, raw), 0
        while head := member.head():
            headers = _headers(head)
            row = _fields(headers)
            keep = head.startswith(b"WARC/") and wanted(row)
            passed += len(head) + (row["block_bytes"] or 0) + 8
            if not keep and row["block_bytes"] is not None and stated[0] and passed >= stated[1]:  # nothing follows in this member
                break
            block = member.take(row["block_bytes"], keep)
            if keep:
                yield headers, row, block
        if head:
            at += stated[0]
        else:
            at = f.tell() - len(member.unzip.unused_data)


def _first_member(f, part: Range) -> int | None:
    """Where the first member that starts in the range starts; a magic number inside a member does not decode to a record."""
    lo = part.start
    while lo < part.end:
        f.seek(lo)
        chunk = f.read(min(1 << 20, part.end - lo) + 256)
        for m in re.finditer(rb"\x1f\x8b\x08", chunk):
            if lo + m.start() >= part.end:
                return None
            try:
                if zlib.decompressobj(31).decompress(chunk[m.start() : m.start() + 256], 5).startswith(b"WARC/"):
                    return lo + m.start()
            except zlib.error:
                pass
        lo += 1 << 20
    return None


def _head(f, at: int) -> tuple[int, bytes, int]:
    """Where the record at or after line ends at `at` starts, its header, and where its block starts; an empty header at the file's end."""
    f.seek(at)
    raw = b""
    while b"\r\n\r\n" not in raw.lstrip(b"\r\n"):
        more = f.read(1 << 11)
        if not more:
            return at + len(raw) - len(raw.lstrip(b"\r\n")), raw.lstrip(b"\r\n"), at + len(raw)
        raw += more
    lead = len(raw) - len(raw.lstrip(b"\r\n"))
    head = raw[lead:].partition(b"\r\n\r\n")[0]
    return at + lead, head, at + lead + len(head) + 4


def _block_end(f, start: int, length: int | None) -> int:
    if length is not None:
        return start + length
    at, tail = start, b""
    f.seek(start)
    while more := f.read(1 << 20):
        if (k := (tail + more).find(_NEXT)) >= 0:
            return at - len(tail) + k
        at, tail = at + len(more), (tail + more)[-len(_NEXT) :]
    return at


def _plain_records(f, part: Range, wanted) -> Iterator[tuple[dict, dict, bytes]]:
    """The records of a plain archive that start in the range. Headers are followed from the file's beginning, without reading blocks: a
    record's text may stand inside another's block, so nothing else tells for certain where a record starts."""
    at = 0
    while at < part.end:
        at, head, start = _head(f, at)
        if not head or at >= part.end:
            return
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at} of the archive")
        headers = _headers(head)
        row = _fields(headers)
        end = _block_end(f, start, row["block_bytes"])
        if at >= part.start and wanted(row):
            f.seek(start)
            yield headers, row, f.read(end - start)
        at = end


@dataclass
class Written(WriterCommitMessage):
    file: str


class WarcWriter(DataSourceWriter):
    """Each task writes a file to a staging folder; commit moves the files of successful tasks, so lost attempts leave nothing."""

    def __init__(self, options: dict):
        self.path, self.zip = options["path"].rstrip("/"), str(options.get("compression", "gzip")).lower() != "none"
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex[:8]}"

    def write(self, rows) -> Written:
        fs, folder = _open(self.staging)
        fs.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.zip
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            info = record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"software: concordat\r\n", {"Content-Type": "application/warc-fields", "WARC-Date": "2024-01-01T00:00:00Z"})
            out.write(member(info) if self.zip else info)
            for row in rows:
                data = page_record(row.asDict())
                out.write(member(data) if self.zip else data)
        return Written(name)

    def commit(self, messages) -> None:
        fs, folder = _open(self.staging)
        for m in messages:
            if m:
                fs.move(f"{folder}/{m.file}", f"{_open(self.path)[1]}/{m.file}")
        if fs.get_file_info(folder).type == pa.fs.FileType.Directory:
            fs.delete_dir(folder)

    def abort(self, messages) -> None:
        fs, folder = _open(self.staging)
        if fs.get_file_info(folder).type == pa.fs.FileType.Directory:
            fs.delete_dir(folder)


def record(kind: str, name: str, block: bytes, headers: dict[str, str]) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), *headers.items(), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member that states its own length and that of its content."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, 24 + len(body) + 8, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def page_record(row: dict) -> bytes:
    """A response, or a revisit without payload, from record_type, record_id, target_uri, date, payload, payload_digest (hex), payload_bytes
    and refers_to."""
    payload = bytes(row.get("payload") or b"")
    clean = re.sub(r"[\x00-\x20\x7f]", "%20", row["target_uri"]) if row.get("target_uri") else None
    headers = {"WARC-Target-URI": clean, "WARC-Date": row["date"], "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()}
    if row["record_type"] == "revisit":
        headers |= {"WARC-Refers-To": f"<{row['refers_to']}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    headers["Content-Type"] = "application/http; msgtype=response"
    length = row["payload_bytes"] if row["record_type"] == "revisit" else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    return record(row["record_type"], row["record_id"], block if row["record_type"] == "revisit" else block + payload, {k: v for k, v in headers.items() if v})


class WarcDataSource(DataSource):
    """spark.read.format("warc").option("payload", "false").load(path); df.write.format("warc").mode("append").save(path)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records to write for pages (page_id, url, html): of equal payloads of SMALL_PAYLOAD bytes or more the one with the largest
    page_id is a response, the others revisit it; smaller payloads are all responses.

    A null html is an empty payload. Rows that share the largest page_id are all responses. A page without page_id is a
    response of its own when no page with one has its payload. An empty table gives no records. Other columns do not matter.

    Which pages are revisits is found on page_id and digest alone, a hot digest spread over tasks. Only pages that a sieve takes for
    revisits go through a join with their payload, by page_id and digest, so no payload follows its digest into one task.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), html.alias("payload")).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    large = base.where(F.col("payload_bytes") >= SMALL_PAYLOAD).select("page_id", "payload_digest")
    last = large.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 AND last IS NOT NULL").drop("n")
    again = cut(spread_join(large, last, ["payload_digest"], F.col("page_id")).where(~F.col("page_id").eqNullSafe(F.col("last"))).select(F.col("page_id").alias("again_id"), F.col("payload_digest").alias("again_digest"), "last").distinct(), "warc-revisits")
    parted = sifted(base, F.xxhash64("page_id", "payload_digest"), sieve(again.select(F.xxhash64("again_id", "again_digest").alias("at")), again.count()))
    joined = parted.where("_likely").join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("payload_digest") == F.col("again_digest")), "left").drop("again_id", "again_digest")
    both = joined.unionByName(parted.where("NOT _likely").withColumn("last", F.lit(None).cast("long")))
    revisit = F.col("last").isNotNull()
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return both.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("date"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, name(F.col("last"))).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the records of page_records() to archives below path, one for each task, beside what is there. A page that cannot be
    written fails the job, and no file of it stays. No pages leave archives without page records."""
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the archives (.warc, .warc.gz) below path, warcinfo and others too, see SCHEMA; header fields that a record lacks are
    null. Without payload, its column is null and payload_bytes stands. A folder without archives gives no rows."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records that read_archives() gave. Responses' figures are taken
    from the payloads themselves, revisits' from their headers."""
    number = lambda c: F.nullif(F.regexp_extract(c, "^urn:page:(-?[0-9]*)$", 1), F.lit("")).cast("long")
    response = F.col("record_type") == "response"
    # both predicates reach the reader: type and id are known from the headers, and other records' blocks are not decoded
    return records.where(F.col("record_type").isin("response", "revisit") & F.col("record_id").startswith("urn:page:")).select(
        number(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
