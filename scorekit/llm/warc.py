"""WARC records in ZIP archives: written from pages, and read back by ranges.

An archive holds stored members: files of WARC records, each record compressed on its own, and an index
of where each record lies. A reader takes the central directory and the index and reads the records
it is asked for, wherever the archive is stored; nothing is extracted.
"""

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces
from scorekit.llm.common import checkpoint
from scorekit.llm.zip_archive import Ranges, ZipWriter, data_start, members

# Payloads of at least this many bytes are revisited when they occur again.
REVISIT_BYTES = 1000

# A member and an archive are closed once they are this large.
MEMBER_BYTES = 8 << 20
ARCHIVE_BYTES = 256 << 20

# Tasks that read archives, at most; more archives than that share them.
READERS = 100_000

# A payload that very many pages share is met by its copies in this many places.
SALTS = 32

RECORDS = "archives", "indexes"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:x-page:"
_CONTROLS = re.compile("[\x00-\x20\x7f]")


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """`page_id, url, payload, payload_digest, refers_to` per row of `pages` (`page_id, url, html`).

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at least
    `revisit_bytes` bytes, those with the largest page_id are the response (`refers_to` null) and the
    others refer to it; all smaller ones are responses. Rows with a null page_id refer to a page that
    has one, or are responses. Equal means equal in SHA-256; the digest is SHA-1.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= revisit_bytes)
    shared = large.groupBy("key").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    shared = checkpoint(shared.where("n > 1").select("key", "response"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(shared.select("key", "response", salts), ["key", "salt"], "left")
    other = ~F.col("response").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.sha1("payload").alias("payload_digest"),
        F.when(other, F.col("response")).alias("refers_to"),
    )


def write_archives(
    records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Write planned records to archives below `folder`; one row per archive: `path, records`.

    Each task writes archives of its own, under names that no other attempt uses, so that a task that
    is run again leaves at most files that no row names. The rows come from a checkpoint: nothing is
    written twice when they are used. `folder` must be on storage that all executors share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for piece in pieces(batches, "payload"):
            for row in zip(*(piece.column(c).to_pylist() for c in _PLANNED)):
                archive = archive or _Archive(folder)
                archive.add(row[0], _record(*row, date))
                if archive.written >= ARCHIVE_BYTES:
                    yield archive.finish()
                    archive = None
        if archive:
            yield archive.finish()

    return checkpoint(records.select(*_PLANNED).mapInArrow(run, "path string, records bigint"))


_PLANNED = ["page_id", "url", "payload", "payload_digest", "refers_to"]


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archives named in `path`, one row each, a task to an archive or to a few.

    Returns `page_id, url, record_type, refers_to, payload_bytes, payload_digest` and, if wanted,
    `payload`, null for revisits. A response's size and digest are those of the payload read, and it is
    an error if the record states another digest; a revisit's are those it states. An archive that is named
    twice is read twice, without archives there are no records, and further columns are not looked at.
    """
    schema = (
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
        "payload_digest string, payload binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in _read(path):
                    rows.append(row if payloads else (*row[:-1], None))
                    size += len(rows[-1][-1] or b"")
                    if len(rows) >= 2048 or size >= 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    # As many tasks as there are archives, which are large: with a number given Spark does not merge them
    # by the size of the paths, and ranges of paths hold one each.
    readers = max(1, min(READERS, archives.count()))
    read = archives.select("path").repartitionByRange(readers, "path").mapInArrow(run, schema)
    return read if payloads else read.drop("payload")


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that Spark names, and the folder's path there."""
    local = re.sub("^file:/*", "/", folder)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", folder), safe=":/@?&=%"))


class _Archive:
    def __init__(self, folder: str):
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        self.path = f"{folder.rstrip('/')}/{name}"
        self.stream = system.open_output_stream(f"{root.rstrip('/')}/{name}")
        self.zip = ZipWriter(self.stream)
        self.member, self.size, self.index, self.count, self.number = [], 0, [], 0, 0

    @property
    def written(self) -> int:
        return self.zip.offset + self.size

    def add(self, page_id: int | None, record: bytes) -> None:
        place = {"page": page_id, "member": self.number, "offset": self.size, "length": len(record)}
        self.index.append(json.dumps(place))
        self.member.append(record)
        self.size += len(record)
        self.count += 1
        if self.size >= MEMBER_BYTES:
            self._close_member()

    def finish(self) -> pa.RecordBatch:
        self._close_member()
        self.zip.finish()
        self.stream.close()
        return pa.RecordBatch.from_pydict({"path": [self.path], "records": [self.count]})

    def _close_member(self) -> None:
        if self.member:
            self.zip.add(f"{RECORDS[0]}/{self.number:06d}.warc.gz", b"".join(self.member))
            self.zip.add(f"{RECORDS[1]}/{self.number:06d}.jsonl", "\n".join(self.index).encode())
            self.member, self.size, self.index = [], 0, []
            self.number += 1


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record, compressed. A revisit has the response's HTTP head but not its body."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # a header ends at a line break, so that such characters are escaped
        escaped = _CONTROLS.sub(lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {escaped}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def _read(path: str) -> Iterator[tuple]:
    system, name = open_folder(path)
    with system.open_input_file(name) as file:
        ranges = Ranges(file, file.size())
        held = members(ranges)
        for index in sorted(n for n in held if n.startswith(RECORDS[1] + "/")):
            lines = ranges(data_start(ranges, held[index]), held[index].size).decode().split("\n")
            number = index.split("/")[1].split(".")[0]
            member = held[f"{RECORDS[0]}/{number}.warc.gz"]
            start = data_start(ranges, member)
            for line in lines:
                place = json.loads(line)
                if place["offset"] + place["length"] > member.size:
                    raise ValueError(f"{index} of {path} points outside of its member")
                record = ranges(start + place["offset"], place["length"])
                yield parse_record(zlib.decompress(record, 31))


def parse_record(data: bytes) -> tuple:
    """Page, url, type, page referred to, payload size, payload digest and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    page_id, refers_to = (_page(fields.get(k)) for k in ("warc-record-id", "warc-refers-to"))
    kind, url = fields["warc-type"], fields.get("warc-target-uri")
    if kind == "revisit":
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
        return page_id, url, kind, refers_to, size, stated, None
    digest = hashlib.sha1(payload).hexdigest()
    if digest != stated:
        raise ValueError(f"page {page_id} has payload {digest}, its record states {stated}")
    return page_id, url, kind, refers_to, len(payload), digest, payload


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(_URN)
    return int(number) if number else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
