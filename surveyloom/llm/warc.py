"""WARC archives: a writer with revisit records, and a salvage reader.

The reader walks an archive record by record. After a failed check (broken member or header, wrong
length, missing end, wrong digest) it searches for the next place where a record can begin (a gzip
member that holds a version line, or a version line in an uncompressed archive), goes on from there and
logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, shared_folder

#: Payloads from this size on are written once; equal ones become revisits.
REVISIT_BYTES = 1000
#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20

MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
# The fields that every record has to have.
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
END = b"\r\n\r\n"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, size, record_type, refers_to). Of equal payloads of ``least`` bytes the largest page_id is the response.

    Null html is empty. Rows without id come after all ids; if a group has no id at all, or rows repeat
    the largest id, all of those are responses.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("size"))
    groups = rows.where(F.col("size") >= least).groupBy(F.col("digest").alias("shared")).agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(groups, (F.col("digest") == F.col("shared")) & (F.col("size") >= least), "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.select("page_id", "url", "html", "digest", "size", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, size: int, kind: str, refers_to) -> bytes:
    """One record; a revisit has no block, but the digest and size of the payload it stands for."""
    block = payload if kind == "response" else b""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{b32}", f"X-Payload-Bytes: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str, compress: bool = True, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the planned records and returns the table of archives (path, records, bytes).

    Every attempt of a task writes files of new names, and only those in the returned table count, so a
    repeated task leaves no double records. The folder has to be one that all executors reach.
    """
    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, count, size, path = None, 0, 0, None

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}], schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * compress
                    path, out, count, size = f"{folder.rstrip('/')}/{name}", system.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None), 0, 0
                data = record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["size"], row["record_type"], row["refers_to"])
                data = member(data) if compress else data
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= limit:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return settle(records.mapInArrow(run, "path string, records long, bytes long"))


class Source:
    """A window over a stream: bytes from ``base`` on; asks for more as needed and forgets what is done."""

    def __init__(self, stream):
        self.stream, self.base, self.data, self.ended = stream, 0, bytearray(), False

    def need(self, at: int, size: int = 1) -> bool:
        """Whether ``size`` bytes from ``at`` (an offset in the archive) are there."""
        while not self.ended and self.base + len(self.data) < at + size:
            more = self.stream.read(CHUNK)
            self.ended = not more
            self.data += more
        return self.base + len(self.data) >= at + size

    def view(self, at: int, size: int | None = None) -> bytes:
        return bytes(self.data[at - self.base:None if size is None else at - self.base + size])

    def forget(self, at: int) -> None:
        if at - self.base > CHUNK:
            del self.data[:at - self.base]
            self.base = at


class Broken(ValueError):
    pass


def head_of(block: bytes) -> tuple[dict[str, str], int]:
    """Fields (lower-case names) and where the block begins."""
    version = VERSION.match(block)
    end = block.find(END)
    if not version or end < 0:
        raise Broken("no record header")
    fields = {}
    for line in block[version.end():end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or re.search(r"[\x00-\x08\x0a-\x1f]", line):
            raise Broken("bad header line")
        fields[name.strip().lower()] = value.strip()
    if any(name not in fields for name in MANDATORY) or not re.fullmatch(r"[0-9]+", fields["content-length"]):
        raise Broken("mandatory field missing")
    return fields, end + len(END)


def checked(fields: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    kind, _, value = fields.get("warc-payload-digest", "").partition(":")
    if fields.get("warc-type") == "response" and kind == "sha1" and base64.b32encode(hashlib.sha1(block).digest()).decode() != value:
        raise Broken("wrong digest")
    return fields, block


def gzip_record(source: Source, at: int):
    """(fields, block, end) of the member at ``at``."""
    unpacker, out, end = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            if not source.need(end):
                raise Broken("truncated member")
            part = source.view(end, CHUNK)
            out.append(unpacker.decompress(part))
            end += len(part) - len(unpacker.unused_data)
            if sum(map(len, out[:1])) >= 7 and not out[0].startswith(b"WARC/1."):
                raise Broken("member without version line")
    except zlib.error as e:
        raise Broken(f"bad member: {e}") from None
    data = b"".join(out)
    fields, start = head_of(data)
    size = int(fields["content-length"])
    if data[start + size:] != END:
        raise Broken("wrong length")
    return *checked(fields, data[start:start + size]), end


def plain_record(source: Source, at: int):
    size = 1 << 12
    while source.need(at, size) and source.view(at, size).find(END) < 0 and size < CHUNK:
        size *= 2
    fields, start = head_of(source.view(at, size))
    length = int(fields["content-length"])
    if not source.need(at + start, length + len(END)) or source.view(at + start + length, len(END)) != END:
        raise Broken("wrong length")
    return *checked(fields, source.view(at + start, length)), at + start + length + len(END)


def next_start(source: Source, at: int) -> int | None:
    """The next place at or after ``at`` where a member that holds a version line, or a version line, begins."""
    while source.need(at, 12):
        window = source.view(at, CHUNK)
        gz = window.find(MAGIC)
        plain = VERSION.search(window)
        here = min(x for x in (gz if gz >= 0 else len(window), plain.start() if plain else len(window)))
        if here == len(window):
            at += max(1, len(window) - 11)
            source.forget(at)
            continue
        at += here
        if source.view(at, 3) != MAGIC:
            return at
        source.need(at, 1 << 12)
        try:
            if zlib.decompressobj(31).decompress(source.view(at, 1 << 12), 7) == b"WARC/1.":
                return at
        except zlib.error:
            pass
        at += 1
    return None


def salvage(stream):
    """Yields ("record", start, end, fields, block) and ("gap", start, end, reason, None) over the whole archive."""
    source, at = Source(stream), 0
    while source.need(at):
        try:
            source.need(at, 3)
            fields, block, end = gzip_record(source, at) if source.view(at, 3) == MAGIC else plain_record(source, at)
        except Broken as e:
            after = next_start(source, at + 1)
            end = after if after is not None else source.base + len(source.data)
            while after is None and source.need(end):
                end = source.base + len(source.data)
            yield "gap", at, end, str(e), None
        else:
            yield "record", at, end, fields, block
        at = end
        source.forget(at)


READ = ("path string, start long, stop long, kind string, reason string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
        "refers_to long, payload binary")


def read_archives(archives: DataFrame, path_col: str = "path", with_payload: bool = True) -> DataFrame:
    """One row per record (kind ``record``) and per quarantined gap (``gap``, with its reason) of the archives listed in ``path_col``.

    Responses carry the digest and length of the payload read, revisits those that they state. Every archive
    is a task of its own (a few share one where ranges of paths cannot be told apart), which reads it in
    bounded memory, one record at a time. Empty archives give no rows.
    """
    def page(field):
        found = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
        return int(found[1]) if found else None

    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with system.open_input_stream(place, compression=None) as stream:
                    for kind, start, end, fields, block in salvage(stream):
                        if kind == "gap":
                            rows.append((path, start, end, kind, fields, None, None, None, None, None, None, None))
                        else:
                            revisit = fields.get("warc-type") == "revisit"
                            digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex() if revisit else hashlib.sha1(block).hexdigest()
                            length = int(fields.get("x-payload-bytes", 0)) if revisit else len(block)
                            rows.append((path, start, end, kind, None, page(fields.get("warc-record-id")), fields.get("warc-target-uri"), fields.get("warc-type"), length, digest,
                                         page(fields.get("warc-refers-to")), block if with_payload else None))
                        size += len(block or b"") * with_payload
                        if len(rows) >= 5000 or size >= CHUNK * 8:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    paths = archives.select(F.col(path_col))
    return paths.repartitionByRange(max(1, paths.count()), F.col(path_col)).mapInArrow(run, READ)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages written as archives below ``folder`` (default: a new one in the shared folder) and read back."""
    return read_archives(write_archives(plan_records(pages), folder or shared_folder(spark)), with_payload=False)


def digest(read: DataFrame) -> DataFrame:
    return read.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
