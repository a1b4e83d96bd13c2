"""WARC archives of single zstandard frames with a shared dictionary.

Layout of an archive (``.warc.zst``): a leading skippable frame (magic
0x184D2A5D) with the compression dictionary, then one frame for each record.
Between frames stands an empty skippable frame, which readers skip: it is the
line separator of Spark's text writer, so that archives are written by
Spark's own committer to any file system it reaches, and a lost executor
leaves no half archive behind.  Files are bounded by records and bytes; the
dictionary frame is written again for each file.

Writing: pages are grouped by payload digest and length (map-side partial, so
a payload that a third of all pages share is no problem); the page with the
largest id of a group is a ``response``, the others are ``revisit`` records
that refer to it and have no payload.  Payloads shorter than ``min_revisit``
bytes are all responses.

Reading: archives come as binary files; the dictionary is taken from the
leading frame (plain or itself compressed), the length of each frame from its
block headers, and exactly one record is decoded from each frame, whether or
not the frame states its content's size.  The version line (1.0 or 1.1), the
header syntax, the block length, the record's end, the HTTP length and the
block and payload digests (of known algorithms) are checked; a record that
fails raises ``ValueError`` with the archive's path and offset.  Records of all
types and with any ids are read.

Defined results: null html is the empty payload; a null url leaves out the
target URI; a page with a null id is written with an empty id and read back
as null, and a group without any id is all responses; rows that repeat the
largest id are all responses; an empty table gives no archive and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICT_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
# An empty skippable frame in ASCII: magic 0x184D2A50, length 0.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
VERSIONS = (VERSION, b"WARC/1.0")
PAGE = "urn:page:"


# Lines of the text writer in a file.
PARTS = 16


class ArchiveError(ValueError):
    """An archive or a record that is not valid."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ records
def _header(lines: list[tuple[str, str]]) -> bytes:
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"


def _uri(url: str) -> str:
    """Control characters and spaces would end the header line: escape them."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def make_record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record; a revisit has no payload but the length and digest of the whole one."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head + (payload if refers_to is None else b"")
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"),
             ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        lines += [("WARC-Refers-To", f"<{PAGE}{refers_to}>"),
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines += [("WARC-Payload-Digest", "sha1:" + digest(payload)),
              ("WARC-Block-Digest", "sha1:" + digest(block)),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(lines) + block + b"\r\n\r\n"


HASHES = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512, "md5": hashlib.md5}


def check_digest(stated: str | None, data: bytes, what: str) -> None:
    """Raise if a labelled digest (base32 or hex) of a known algorithm differs."""
    name, _, value = (stated or "").partition(":")
    if name.lower() in HASHES:
        own = HASHES[name.lower()](data).digest()
        if value.upper().rstrip("=") != base64.b32encode(own).decode().rstrip("=") and value.lower() != own.hex():
            raise ArchiveError(f"{what} digest differs")


def _fields(lines: list[bytes]) -> dict:
    """Named fields by lower-case name; folded lines are joined, and only
    WARC-Concurrent-To may come more than once (the first is kept)."""
    fields: dict = {}
    last = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last is not None:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"bad header line {line[:80]!r}")
        last = name.lower()
        if last in fields and last != b"warc-concurrent-to":
            raise ArchiveError(f"repeated header {name!r}")
        fields.setdefault(last, value.strip().decode("utf-8", "replace"))
    return fields


def parse_record(data: bytes) -> dict:
    """Fields of one record of any type, checked.  Responses and revisits that
    hold an HTTP message have its body as payload, other records their block."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(tuple(v + b"\r\n" for v in VERSIONS)) or end < 0:
        raise ArchiveError("no WARC version line or header end")
    fields = _fields(data[:end].split(b"\r\n")[1:])
    for name in (b"warc-type", b"warc-record-id", b"warc-date", b"content-length"):
        if name not in fields:
            raise ArchiveError(f"no header {name.decode()}")
    length = fields[b"content-length"]
    if not (length.isascii() and length.isdecimal()):
        raise ArchiveError(f"bad length {length!r}")
    block, tail = data[end + 4:end + 4 + int(length)], data[end + 4 + int(length):]
    if len(block) != int(length) or tail != b"\r\n\r\n":
        raise ArchiveError(f"block of {length} bytes does not end the record")
    check_digest(fields.get(b"warc-block-digest"), block, "block")
    kind, payload, size = fields[b"warc-type"].lower(), block, len(block)
    http = kind in ("response", "revisit") and \
        fields.get(b"content-type", "application/http").lower().startswith("application/http")
    if http and (kind == "response" or block):
        at = block.find(b"\r\n\r\n")
        if at < 0:
            raise ArchiveError("no end of the HTTP header")
        payload = block[at + 4:]
        declared = {x.partition(b":")[2].strip() for x in block[:at].split(b"\r\n")
                    if x.lower().startswith(b"content-length:")}
        if len(declared) > 1 or any(not d.isdigit() for d in declared):
            raise ArchiveError("bad payload length")
        size = int(declared.pop()) if declared else None if kind == "revisit" else len(payload)
        if kind == "response" and size != len(payload) and b"warc-truncated" not in fields:
            raise ArchiveError("payload length differs")
    refers = fields.get(b"warc-refers-to")
    stated = fields.get(b"warc-payload-digest")
    if kind == "revisit":
        if http and block and payload or not refers and b"warc-refers-to-target-uri" not in fields:
            raise ArchiveError("revisit with a payload or without its response")
    elif b"warc-truncated" not in fields:
        check_digest(stated, payload, "payload")
    if stated is None and kind == "response":
        stated = "sha1:" + digest(payload)
    number, other = (_page(x) if x else None for x in (fields[b"warc-record-id"], refers))
    return {"page_id": number, "url": fields.get(b"warc-target-uri"), "payload_bytes": size,
            "payload_digest": None if stated is None else stated.removeprefix("sha1:"), "record_type": kind,
            "refers_to": other if kind == "revisit" else None,
            "record_id": fields[b"warc-record-id"].strip("<>"), "refers_to_id": refers and refers.strip("<>"),
            "content_type": fields.get(b"content-type"), "payload": None if kind == "revisit" else payload}


def _page(uri: str):
    """The page id of a record id that ``make_record`` wrote, else None."""
    number = uri.strip("<>").removeprefix(PAGE)
    return int(number) if uri.startswith(f"<{PAGE}") and number.lstrip("-").isdecimal() else None


# ------------------------------------------------------------------- frames
def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(data)) + data


def frame_end(buf, at: int) -> int:
    """End of the zstandard frame at ``at``, from its frame and block headers."""
    try:
        flags = buf[at + 4]
        single = flags >> 5 & 1
        p = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
        while True:
            block = buf[p] | buf[p + 1] << 8 | buf[p + 2] << 16
            kind = block >> 1 & 3
            if kind == 3:
                raise ArchiveError(f"reserved block type at {p}")
            p += 3 + (1 if kind == 1 else block >> 3)
            if block & 1:
                break
        p += 4 * (flags >> 2 & 1)
    except IndexError:
        p = len(buf) + 1
    if p > len(buf):
        raise ArchiveError(f"frame at {at} is cut off")
    return p


def read_archive(buf: bytes):
    """(offset, record bytes) of every frame; the dictionary comes from the leading skippable frame."""
    at, reader, view = 0, zstandard.ZstdDecompressor(), memoryview(buf)
    while at < len(buf):
        if len(buf) - at < 8:
            raise ArchiveError(f"{len(buf) - at} bytes left at {at}")
        magic, size = struct.unpack_from("<II", buf, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(buf):
                raise ArchiveError(f"skippable frame at {at} is cut off")
            if magic == DICT_MAGIC:
                if at:
                    raise ArchiveError(f"dictionary at {at}, not in front")
                data = bytes(view[8:8 + size])
                if data[:4] == struct.pack("<I", FRAME_MAGIC):
                    data = zstandard.ZstdDecompressor().decompress(data)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ArchiveError(f"no frame at {at}")
        end = frame_end(buf, at)
        try:
            # a frame need not state its content's size
            frame = reader.decompressobj()
            data = frame.decompress(view[at:end])
            if not frame.eof:
                raise ArchiveError(f"frame at {at} does not end")
        except zstandard.ZstdError as e:
            raise ArchiveError(f"frame at {at}: {e}") from e
        yield at, data
        at = end


# -------------------------------------------------------------- Spark sides
def train_dictionary(pages: DataFrame, *, html_col: str = "html", sample_pages: int = 256,
                     sample_bytes: int = 16384, size: int = 65536) -> bytes:
    """A dictionary from a bounded sample of pages (``sample_pages`` pages, of
    each ``sample_bytes`` bytes at most).  It only affects how small archives
    get, never what they hold.  Empty if the sample is too small."""
    sample = pages.select(F.substring(F.col(html_col), 1, sample_bytes).alias("h")) \
        .filter(F.length("h") > 0).limit(sample_pages).collect()
    texts = [r.h.encode("utf-8", "replace") for r in sample]
    if len(texts) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, texts)) // 8), texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def record_types(pages: DataFrame, *, id_col: str, url_col: str, html_col: str,
                 min_revisit: int) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    key = [F.unhex(F.sha1(F.col("html").cast("binary"))).alias("key"), F.octet_length("html").alias("size")]
    largest = rows.select("page_id", *key).groupBy("key", "size") \
        .agg(F.max("page_id").alias("largest"))
    refers = F.when((F.col("size") >= min_revisit) & F.col("largest").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return rows.select("*", *key).join(largest, ["key", "size"]) \
        .select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = 0, records_per_archive: int = 4096,
                   archive_bytes: int = 64 << 20, level: int = 3, date: str | None = None,
                   dictionary: bytes | None = None) -> None:
    """Write one record per page to archives below ``path``, each of at most
    about ``records_per_archive`` records and ``archive_bytes`` bytes (more by
    a record for each of its ``PARTS``).

    A line of the text writer holds consecutive frames, cut by number and
    bytes; a file holds ``PARTS`` lines."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    data = train_dictionary(pages, html_col=html_col) if dictionary is None else dictionary
    rows = record_types(pages, id_col=id_col, url_col=url_col, html_col=html_col, min_revisit=min_revisit)
    parts = min(PARTS, records_per_archive)
    most, room = max(1, records_per_archive // parts), max(1, archive_bytes // parts)

    def frames(batches):
        prime = zstandard.ZstdCompressionDict(data) if data else None
        write = zstandard.ZstdCompressor(level=level, dict_data=prime, write_checksum=True)
        # without a dictionary the leading frame is an empty skippable one
        lead = dictionary_frame(data) if data else SEPARATOR.encode()
        lines, line, held, n = 0, [], 0, 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(line)], pa.binary())], ["frame"])

        for b in batches:
            for page, url, html, refers in zip(*(b.column(c).to_pylist() for c in
                                                 ("page_id", "url", "html", "refers_to"))):
                if not line and lines % parts == 0:
                    line.append(lead)
                line.append(write.compress(make_record(page, url, html.encode("utf-8", "replace"), refers, date)))
                held, n = held + len(line[-1]), n + 1
                if held >= room or n == most:
                    yield full()
                    lines, line, held, n = lines + 1, [], 0, 0
        if line:
            yield full()

    rows.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value")) \
        .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", parts).text(path)


_READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, record_id string, refers_to_id string, content_type string, payload binary")


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``, of whatever type, checked:
    response, revisit, request, resource, metadata, warcinfo and others.  Ids
    that ``write_archives`` did not give are in record_id and refers_to_id."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id",
             "refers_to_id", "content_type"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def records(batches):
        for b in batches:
            for i in range(b.num_rows):
                name, at, rows, held = b.column("path")[i].as_py(), 0, [], 0
                try:
                    for at, data in read_archive(b.column("content")[i].as_py()):
                        r = parse_record(data)
                        rows.append([r[c] for c in names])
                        held += len(data)
                        if held > 1 << 24:
                            yield _rows(rows, names, types)
                            rows, held = [], 0
                except ArchiveError as e:
                    raise ArchiveError(f"{name} at {at}: {e}") from e
                if rows:
                    yield _rows(rows, names, types)

    schema = _READ if with_payload else _READ.removesuffix(", payload binary")
    return files.mapInArrow(records, schema)


def _rows(rows: list, names: list, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
