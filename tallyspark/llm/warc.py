"""Legacy archive converter: ARC files to WARC files.

``parse_arc`` reads ARC files of version 1 and 2.  The version block of a file tells which header line its records
have; a record's body is as long as its header declares, whatever it contains.  ``convert`` gives each record the WARC
identifiers it lacks: a record id from file and offset, an ISO date from the 14-digit one, a type, a
block digest and a payload digest.  Payloads that occur more than once become one response and revisits.
``write_warc`` and ``read_warc`` write WARC files and read them back by their declared lengths.

Files are written by Spark's text sink with the record separator as line separator, so that commits, retries and any
file system that Spark knows are Spark's business; they are gzipped whole, and hold at most ``records`` records each.  Gzipped
files are read the same way: the text source streams a file through one task, cut at a string that every record has (its
HTTP line, its WARC line), and the cuts are closed again before records are taken by their lengths.  A task so holds a
batch of such pieces and one record, whatever the file's size.  Files that are not gzipped by name are read one a row.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, written

RECORDS = 500  # of a file
SMALLEST_SHARED = 1000  # bytes of a payload that may be stored once for many records
ARC_FIELDS = {  # of a record's header line, by the version that the version block names
    1: ["url", "ip", "date", "content_type", "length"],
    2: ["url", "ip", "date", "content_type", "result_code", "checksum", "location", "offset", "filename", "length"],
}
WARC_END = "\r\n\r\n"
ARC_MARK, WARC_MARK = b"HTTP/1.", b"WARC/1."  # where the text source cuts files for reading: once a record, as a rule
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}  # archives are read far less often than payloads are packed


# -- reading byte streams -------------------------------------------------------------------------------------------


class Stream:
    """Bytes of an archive, taken from its pieces as they are asked for."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.held, self.offset = iter(pieces), bytearray(), 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held += piece
        return piece is not None

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError(f"archive ends {n - len(self.held)} bytes early, at {self.offset + len(self.held)}")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self.more():
                if bytes(self.held).strip():
                    raise ValueError(f"archive ends within a header at {self.offset}")
                return None
        return self.take(at + len(mark))


def unpacked(content: bytes) -> Iterator[bytes]:
    """Pieces of a file's content, of all its gzip members if it is gzipped."""
    left = memoryview(content)
    if content[:2] != b"\x1f\x8b":
        for i in range(0, len(left), 1 << 16):
            yield bytes(left[i:i + (1 << 16)])
        return
    unpack = zlib.decompressobj(31)
    while len(left):
        part, left = left[:1 << 16], left[1 << 16:]
        yield unpack.decompress(part)
        while unpack.eof and unpack.unused_data:  # the next member
            rest, unpack = unpack.unused_data, zlib.decompressobj(31)
            yield unpack.decompress(rest)
        if unpack.eof:
            unpack = zlib.decompressobj(31)


_FRONT = re.compile(rb"(?P<url>.*) (?P<ip>[0-9A-Fa-f.:]+|-) (?P<date>\d{14}|-) (?P<content_type>.*)", re.DOTALL)


def plain(raw: bytes) -> str:
    """Header text: UTF-8 or, where it is none, Latin-1, which every byte is."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def header_fields(line: bytes, version: int) -> dict[str, str]:
    """The fields of a record's header line, read from the right: the length, the fields of version 2 without blanks, then the content
    type behind the last address and date; what stands before these is the URL, blanks and all.  Where they are
    not found the URL is all that stands before the length and the other fields are '-'.  ValueError without a length."""
    names = ARC_FIELDS[version]
    parts = line.rstrip(b"\r\n").rsplit(b" ", len(names) - 4)
    if not parts[-1].isdigit():
        raise ValueError("no length in an ARC header")
    found = _FRONT.fullmatch(parts[0]) if len(parts) == len(names) - 3 else None
    if not found:
        return dict.fromkeys(names, "-") | {"url": plain(line.rstrip(b"\r\n").rsplit(b" ", 1)[0]), "length": plain(parts[-1])}
    return {n: plain(v) for n, v in found.groupdict().items()} | dict(zip(names[4:], map(plain, parts[1:]), strict=True))


def arc_records(pieces: Iterable[bytes]) -> Iterator[dict]:
    """The records of an ARC file: the header line's fields, ``at`` (offset in the unpacked file) and ``body``."""
    s = Stream(pieces)
    head = s.until(b"\n")
    if head is None:
        return
    if not head.startswith(b"filedesc://"):
        raise ValueError("no ARC version block")
    block = s.take(int(head.split()[-1]))
    version = int(block.split(b" ", 1)[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"ARC version {version}")
    while True:
        at = s.offset
        head = s.until(b"\n")
        if head is None:
            return
        if not head.strip():  # line ends between records
            continue
        try:
            record = header_fields(head, version)
        except ValueError as e:
            raise ValueError(f"{e} at {at}") from None
        yield record | {"at": at, "version": version, "body": s.take(int(record["length"]))}


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; without a head all is payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    at = body.find(b"\r\n\r\n")
    return (body, b"") if at < 0 else (body[:at + 4], body[at + 4:])


def warc_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file."""
    s = Stream(pieces)
    while (line := s.until(b"\n")) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {s.offset - len(line)}")
        fields: dict[str, str] = {}
        while (line := s.until(b"\n")) is not None and line.strip():
            name, _, value = plain(line).partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, s.take(int(fields["content-length"]))


# -- ARC ------------------------------------------------------------------------------------------------------------


def field(c: Column) -> Column:
    """A header field: no white space or control characters in it, '-' for nothing."""
    return F.coalesce(F.nullif(F.regexp_replace(c.cast("string"), r"[\x00-\x20\x7f]+", "_"), F.lit("")), F.lit("-"))


def write_arc(pages: DataFrame, path: str, version: int = 1, date: str = "20240301000000", records: int = RECORDS) -> None:
    """One ARC record per row of ``pages`` (page_id, url, html): an HTTP response with the html in UTF-8 (null: empty) as
    payload; its head names the page_id, if there is one.  Each file begins with its version block."""
    html = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"),
                    F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")), F.lit("\r\n\r\n"))
    known = {"url": field(F.col("url")), "ip": F.lit("0.0.0.0"), "date": F.lit(date), "content_type": F.lit("text/html"), "result_code": F.lit("200"),
             "length": (F.octet_length("head") + F.octet_length("html")).cast("string")}
    line = F.concat_ws(" ", *[known.get(name, F.lit("-")) for name in ARC_FIELDS[version]])
    rows = pages.select("page_id", "url", html.alias("html"), head.alias("head")).select(F.concat(line, F.lit("\n"), F.col("head"), F.col("html")).alias("value"))
    about = f"{version} 0 tallyspark\n{' '.join(ARC_FIELDS[version])}\n"
    block = " ".join({"url": "filedesc://pages.arc", "ip": "0.0.0.0", "date": date, "content_type": "text/plain", "length": str(len(about) + 1)}.get(x, "-")
                     for x in ARC_FIELDS[version]) + f"\n{about}"

    # the version block goes before the first record of each file, that is of each ``records`` rows of a task; a row's number
    # in its task is the lower 33 bits of this id
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) % records == 0
    rows.select(F.concat(F.when(first, F.lit(f"{block}\n")).otherwise(F.lit("")), "value").alias("value")).write.options(**GZIP).option("lineSep", "\n").option("maxRecordsPerFile", records).text(path)


def parse_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files below ``path``: file, at, version, url, ip, date, content_type, page_id, digest (SHA-1 of the
    payload in lower-case hex), size, http_head, payload."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        for name, pieces in files_of(batches, ARC_MARK):
            for r in arc_records(pieces):
                head, payload = split_http(r["body"])
                page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
                yield (name, r["at"], r["version"], r["url"], r["ip"], r["date"], r["content_type"], page and int(page[1]), hashlib.sha1(payload).hexdigest(),
                       len(payload), head, payload), len(r["body"])

    return archives(spark, path, ARC_MARK).mapInArrow(lambda batches: in_batches(made(batches), ARC_TYPES), ", ".join(f"{n} {sql}" for n, sql, _ in ARC_TYPES))


ARC_TYPES = [("file", "string", pa.string()), ("at", "long", pa.int64()), ("version", "int", pa.int32()), ("url", "string", pa.string()),
             ("ip", "string", pa.string()), ("date", "string", pa.string()), ("content_type", "string", pa.string()), ("page_id", "long", pa.int64()),
             ("digest", "string", pa.string()), ("size", "long", pa.int64()), ("http_head", "binary", pa.binary()), ("payload", "binary", pa.binary())]


def in_batches(rows: Iterator[tuple[tuple, int]], types: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows, each with its bytes, in batches of about 4 MB."""
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n + 256
        if size > 1 << 22:
            yield packed(held, types)
            held, size = [], 0
    if held:
        yield packed(held, types)


def packed(rows: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, _, t) in enumerate(types)], [n for n, _, _ in types])


def archives(spark: SparkSession, path: str, mark: bytes) -> DataFrame:
    """(name, whole, piece) of the files below ``path``: gzipped ones in pieces cut at ``mark``, in order and all in one task, as gzip
    cannot be split; others whole."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name")
    pieces = spark.read.option("lineSep", mark.decode()).option("pathGlobFilter", "part-*.gz").text(path).select(
        name, F.lit(False).alias("whole"), F.col("value").cast("binary").alias("piece"))
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "part-*[!z]").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(True).alias("whole"), F.col("content").alias("piece"))
    return pieces.unionByName(whole)


def files_of(batches: Iterator[pa.RecordBatch], mark: bytes) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(name, pieces) of each file, its cuts at ``mark`` closed."""
    def rows() -> Iterator[tuple[str, bool, bytes]]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py()

    for name, own in itertools.groupby(rows(), key=lambda r: r[0]):
        yield name, itertools.chain.from_iterable(unpacked(piece) if whole else (piece,) if i == 0 else (mark, piece) for i, (_, whole, piece) in enumerate(own))


# -- conversion -----------------------------------------------------------------------------------------------------


def convert(parsed: DataFrame) -> DataFrame:
    """WARC records of parsed ARC records (``parse_arc``; read twice, so pass a written table): record_id, refers_to_id and
    refers_to (page_id; null unless a revisit), record_type, url, ip, date (ISO), content_type, page_id, digest (lower-case
    hex SHA-1 of the payload), size, http_head, payload (empty in a revisit).

    A record's id is made from its file and offset.  Of records with equal payloads of SMALLEST_SHARED bytes or more the one with
    the largest page_id (then id; a null page_id comes last) is the response.  The groups are found from digests alone,
    added up in the map tasks; only one row per repeated payload is kept, written, and joined back.
    """
    marks = [F.xxhash64("file", "at"), F.xxhash64("at", "file")]
    rows = parsed.withColumn("m1", marks[0]).withColumn("m2", marks[1])
    # numbers only: groups of fixed width stay in a hash aggregation
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page"), "m1", "m2", "page_id")
    shared = (rows.where(F.col("size") >= SMALLEST_SHARED).groupBy("digest").agg(F.max(order).alias("top"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select(F.col("digest").alias("s_digest"), F.col("top.m1").alias("s_m1"), F.col("top.m2").alias("s_m2"), F.col("top.page_id").alias("s_page")))
    shared = written(shared, "shared")
    revisit = F.col("s_digest").isNotNull() & ((F.col("m1") != F.col("s_m1")) | (F.col("m2") != F.col("s_m2")))
    joined = rows.join(shared, (F.col("digest") == F.col("s_digest")) & (F.col("size") >= SMALLEST_SHARED), "left")
    when = F.date_format(F.try_to_timestamp("date", F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return joined.select(
        record_id("m1", "m2").alias("record_id"), F.when(revisit, record_id("s_m1", "s_m2")).alias("refers_to_id"), F.when(revisit, F.col("s_page")).alias("refers_to"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), "url", "ip", when.alias("date"), "content_type",
        "page_id", "digest", "size", "http_head", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def record_id(*marks: str) -> Column:
    """``urn:uuid:`` of two 64-bit numbers."""
    digits = F.lower(F.concat(*[F.lpad(F.hex(m), 16, "0") for m in marks]))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def write_warc(records: DataFrame, path: str, per_file: int = RECORDS) -> None:
    """WARC/1.1 records, each with its declared length, block digest and payload digest (base 32, as is the custom)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = warc_bytes(batch.slice(k, 1).to_pylist()[0])
                yield (raw,), len(raw)

    values = records.mapInArrow(lambda batches: in_batches(made(batches), [("value", "binary", pa.binary())]), "value binary").select(F.col("value").cast("string").alias("value"))
    values.write.options(**GZIP).option("lineSep", WARC_END).option("maxRecordsPerFile", per_file).text(path)


def warc_bytes(r: dict) -> bytes:
    block = r["http_head"] + r["payload"]
    fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", r["date"] or "1970-01-01T00:00:00Z"),
              ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("Content-Type", "application/http; msgtype=response" if r["http_head"] else r["content_type"]),
              ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(r['digest'])).decode()}"),
              ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}")]
    if r["record_type"] == "revisit":
        fields += [("WARC-Refers-To", f"<{r['refers_to_id']}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        fields.append(("X-Payload-Length", str(r["size"])))
        if r["refers_to"] is not None:
            fields.append(("X-Refers-To-Page-Id", str(r["refers_to"])))
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block


READ_TYPES = [("record_id", "string", pa.string()), ("record_type", "string", pa.string()), ("refers_to_id", "string", pa.string()),
              ("refers_to", "long", pa.int64()), ("url", "string", pa.string()), ("date", "string", pa.string()), ("page_id", "long", pa.int64()),
              ("payload_bytes", "long", pa.int64()), ("payload_digest", "string", pa.string()), ("payload", "binary", pa.binary())]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files below ``path``.  A stored payload is hashed again and must have the declared digest, as
    must the block; a revisit has the length that its header declares and a null payload."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int]]:
        for _, pieces in files_of(batches, WARC_MARK):
            for fields, block in warc_records(pieces):
                yield read_record(fields, block), len(block)

    return archives(spark, path, WARC_MARK).mapInArrow(lambda batches: in_batches(made(batches), READ_TYPES), ", ".join(f"{n} {sql}" for n, sql, _ in READ_TYPES))


def unpacked_digest(value: str) -> str:
    return base64.b32decode(value.removeprefix("sha1:")).hex()


def read_record(f: dict[str, str], block: bytes) -> tuple:
    head, payload = split_http(block)
    declared = unpacked_digest(f["warc-payload-digest"])
    if hashlib.sha1(block).hexdigest() != unpacked_digest(f["warc-block-digest"]):
        raise ValueError(f"block of {f['warc-record-id']} differs from its digest")
    revisit = f["warc-type"] == "revisit"
    if revisit:
        length = int(f["x-payload-length"])
    elif hashlib.sha1(payload).hexdigest() != declared:
        raise ValueError(f"payload of {f['warc-record-id']} differs from its digest")
    else:
        length = len(payload)
    page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    to = f.get("x-refers-to-page-id")
    return (f["warc-record-id"].strip("<>"), f["warc-type"], f["warc-refers-to"].strip("<>") if revisit else None, int(to) if to else None,
            f["warc-target-uri"], f["warc-date"], page and int(page[1]), length, declared, None if revisit else payload)


def archive_pages(pages: DataFrame, version: int = 1) -> DataFrame:
    """Write ``pages`` (page_id, url, html; others are left out) as ARC, convert to WARC, read the WARC files back.

    One row per row of ``pages``, repeated rows included (all but one of them revisits, if large enough): the columns of
    ``read_warc``.  A null html is an empty payload, a null page_id comes back null, an empty table gives an empty result.
    """
    spark = pages.sparkSession
    arc, out = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    write_arc(pages, arc, version)
    write_warc(convert(written(parse_arc(spark, arc), "parsed")), out)
    return read_warc(spark, out)
